import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PAGES = "page_id long, url string, html string"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


WORDS = " ".join(f"word{i}" for i in range(60))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows,
    and columns whose names clash with those of results."""
    rows = [
        (1, "", "en", "a", 0), (2, None, "en", "a", None), (3, " \n\t ", None, "a", 4), (None, "a b c", "en", None, 5),
        (4, "a b c", "en", "b", 5), (5, "A b C", "en", "b", 5), (6, WORDS, "en", "b", 9), (6, WORDS, "en", "b", 9),
        (7, WORDS, "fr", "c", 9), (8, WORDS.replace("word30", "other"), "fr", "c", 9), (9, "x", None, None, None),
        (10, "long " * 20_000 + "end", "de", "c", 1), (11, "é漢\U0001F600 ▁ \x00 <s>", "de", "c", 1), (None, None, None, None, None),
    ]
    clash = ", kept boolean, n_words long, component_id string, shard int, node string, _row string, size long, key string"
    return spark.createDataFrame([r + (None, -1, "x", 99, "n", "r", -5, "k") for r in rows], DOCS + clash)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df, *columns):
    """doc_id -> the named columns, as a list for repeated ids."""
    out = {}
    for r in df.collect():
        out.setdefault(r[0], []).append(tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]])
    return out
