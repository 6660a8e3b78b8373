import numpy as np

from tabulint.llm import QUERIES, language
from tabulint.llm.quality import held_out


def test_held_out_accuracy(llm, sf_medium):
    found = QUERIES["op9_language"](llm, sf_medium)
    rows = found.join(llm.read.parquet(f"{sf_medium}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 300 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_texts(llm, odd, empty):
    known = [(i, "the cat and the dog " * 5, "en") for i in range(30)] + [(50 + i, "le chat et les chiens ou la " * 5, "fr") for i in range(30)]
    model = language.train(llm.createDataFrame(known, "doc_id long, text string, lang string"))
    found = {r.doc_id: r for r in language.identify(odd, model).collect()}
    for i in (0, 1, 2, 4):
        assert (found[i].lang_pred, found[i].score, found[i].rejected) == ("und", 0.0, True)
    assert {r.lang_pred for r in found.values()} <= {"und", "en", "fr"} and found[3].lang_pred != "und"
    assert language.identify(empty, model).count() == 0
    learnt = [t for t in ("the dog and the cat", "les chiens et la") for _ in (0,)]
    docs = llm.createDataFrame(list(enumerate(learnt)), "doc_id long, text string")
    assert [r.lang_pred for r in language.identify(docs, model).orderBy("doc_id").collect()] == ["en", "fr"]


def test_nothing_to_learn_from(odd):
    model = language.train(odd.filter("lang IS NULL"))
    assert {r.lang_pred for r in language.identify(odd, model).collect()} == {"und"}


def test_held_out_rows(llm):
    import zlib

    docs = llm.range(50).withColumnRenamed("id", "doc_id")
    assert [r[0] for r in docs.orderBy("doc_id").select(held_out()).collect()] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(50)]


def test_pieces_are_counts_of_subwords(monkeypatch):
    text = ("Der Hund und die Katze, the dog and the cat! " * 40).encode()
    data, table = np.frombuffer(text, np.uint8), language.subword_table()
    all_ = np.concatenate([x for _, x in language.subwords(data, table)])
    found = language.pieces(text)
    assert len(found) == 1 + language.PASSES * len(language.SNIPPETS)
    numbers, times = np.unique(all_, return_counts=True)
    assert found[0][0].tolist() == numbers.tolist() and found[0][1].tolist() == times.tolist()
    for (_, n), size in zip(found[1:], language.SNIPPETS * language.PASSES):
        assert n.sum() == sum(size - order + 1 for order in language.ORDERS)
    least = language.pieces(text, most=20)[0]
    assert len(least[0]) == 20 and sorted(least[1])[0] >= sorted(times)[-20] and (np.diff(least[0].astype(int)) > 0).all()
    assert all(len(n) == 0 for n, _ in language.pieces(b""))
    monkeypatch.setattr(language, "COUNT_BYTES", 100)
    assert [[x.tolist() for x in c] for c in language.pieces(text)] == [[x.tolist() for x in c] for c in found]


def test_fit_on_long_texts_sends_bounded_rows(llm):
    """A text of 2 MB beside short ones: what reaches the driver does not grow with it, and the model still tells languages apart."""
    r = np.random.default_rng(3)
    long_ = " ".join("".join(map(chr, r.integers(97, 123, 6))) for _ in range(300_000))
    rows = [(i, "the cat and the dog " * 5, "en") for i in range(60)] + [(100 + i, "le chat et les chiens ou la " * 5, "fr") for i in range(60)]
    docs = llm.createDataFrame([*rows, (300, long_, "xx"), (301, "", "en"), (302, None, "fr"), (302, "le chat", "fr")], "doc_id long, text string, lang string")
    assert sum(n.nbytes + t.nbytes for n, t in language.pieces(long_.encode())) <= 6 * language.PIECE_SUBWORDS + 25_000
    model = language.train(docs)
    new = llm.createDataFrame([(1, "the dog and the cat"), (2, "les chiens et la")], "doc_id long, text string")
    assert [r.lang_pred for r in language.identify(new, model).orderBy("doc_id").collect()] == ["en", "fr"]
