import random

import pytest

WORDS = {
    "en": "the of and to in is that it for on was with as by this thing other house water people never always".split(),
    "de": "der die und das ist nicht mit auf für eine sich auch über können müssen straße wasser häuser niemals".split(),
    "fr": "le la les des une est pas que pour dans être très où déjà maison jamais toujours élève français".split(),
}


def prose(rng: random.Random, lang: str, n: int) -> str:
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", str(rng.randrange(50))]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text, lang, source, n_chars): prose, copies, near copies, shared passages, odd texts."""
    rng = random.Random(3)
    texts = []
    for _ in range(60):
        lang = rng.choice(list(WORDS))
        texts.append((prose(rng, lang, rng.randrange(1, 200)), lang))
    shared = prose(rng, "en", 70)
    for k in range(12):
        texts.append((f"{prose(rng, 'en', 40)}\n{shared}\n{prose(rng, 'en', 20 + k)}", "en"))
    for k in (3, 3, 3, 7):
        texts.append(texts[k])
    for k in (10, 11, 12):
        words = texts[k][0].split(" ")
        words[len(words) // 2] = "changed"
        texts.append((" ".join(words), texts[k][1]))
    line = prose(rng, "de", 20)
    texts.append(("\n".join([line] * 30), "de"))
    texts += [(None, None), ("", "en"), ("", None), (" \t\n ", "en"), ("12 345 !!", "de"), ("▁ mark <|endoftext|> é 漢字🙂", "fr"),
              ("a", "en"), ("x" * 5000, "en"), (prose(rng, "fr", 6000), "fr"), ("two words", "en")]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(i, texts[j][0], texts[j][1], f"src{i % 3}", len(texts[j][0] or "")) for i, j in enumerate(order)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def clashing():
    """Names that the operators use inside, as further columns."""
    names = ("key kind blob fp rep component_id pair tree n words tokens seed at start item same piece ids part shard row "
             "n_words n_removed ladders value level pos lang_pred score held_out place rank pieces decoded n_tokens a b u v m "
             "__state __lang_pred __score __n_words __n_removed __kept_sha256 k0 q t w h code per")

    def add(df):
        from pyspark.sql import functions as F

        return df.withColumns({c: F.lit("x") for c in names.split() if c not in df.columns})

    return add
