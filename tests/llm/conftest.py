import pytest

from tabulint.llm.shipping import ship

LONG = " ".join(f"w{i * i % 9973}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(80))

TEXTS = [
    None,
    "",
    "   \n\t ",
    "a",
    "!!! ??? ...",
    "one two three",
    PASSAGE,
    f"start of mine {PASSAGE} and my own end of it all",
    f"{PASSAGE}\nsecond line here\nthird line here\nfourth line here\nfifth line here",
    "second line here\nthird line here\nfourth line here\nfifth line here\nmore words follow",
    "ab " * 200,
    "élève où ça naïve 日本語 テキスト " * 10,
    LONG,
    LONG.replace("w1 ", "other ", 3),
    "a" * 500,
    "same text in many rows, every word of it again and again to make it long enough for all windows to matter",
]


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text): odd texts, copies of one, and a hot text."""
    out = list(enumerate(TEXTS))
    return out + [(100 + i, TEXTS[-1]) for i in range(40)] + [(200, TEXTS[7]), (201, LONG)]


@pytest.fixture(scope="session")
def odd(llm, rows):
    """The rows as documents, with further columns whose names the operators use inside."""
    extra = "id long, k long, name string, first long, n long, digest string, rank int, score_ string, part int, runs string, positions string, __cut int, __runs int, __p string, __lang int, __key int, __of int, __sha string, label int"
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
    data = [(i, t, "en", "s", len(t or ""), i, i, "x", 1, 2, "d", 3, "z", 4, "r", "p", 5, 6, "q", 7, 8, 9, "s", 10) for i, t in rows]
    return llm.createDataFrame(data, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
