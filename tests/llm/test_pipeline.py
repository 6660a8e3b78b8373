"""The pipeline's stages against brute force, one after the other on the same rows."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from tabulint.llm import ORACLES, QUERIES, decontamination, quality
from tabulint.llm.storage import stored
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_near_dedup import classes


@pytest.fixture(scope="module")
def stages(llm, sf_small):
    docs, out = llm.read.parquet(f"{sf_small}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(llm, docs, sf_small), name)
        out.append((name, docs))
    return dict(out)


def texts(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_every_operator_is_registered():
    names = set(driver.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert set(ORACLES) <= set(driver.oracle_sql())


def test_stages_keep_the_columns(stages):
    for name, docs in list(stages.items())[:-1]:
        assert docs.columns == corpus_pipeline.COLUMNS


def test_stages_equal_brute_force(llm, sf_small, stages):
    raw = llm.read.parquet(f"{sf_small}/documents.parquet")
    model = quality.train(raw, llm.read.parquet(f"{sf_small}/labels.parquet"))
    good = {r.doc_id for r in quality.score(raw, model).filter("score >= 0.5").collect()}
    assert {i for i, _ in texts(stages["quality_classifier"])} == good

    expected = {i: t for i, (t, _, _) in brute_lines(texts(stages["quality_classifier"])).items()}
    assert dict(texts(stages["line_dedup"])) == expected

    named = classes(texts(stages["line_dedup"]))
    assert {i for i, _ in texts(stages["near_dedup"])} == set(named.values())

    items = [w for _, w in decontamination.rows(column(llm.read.parquet(f"{sf_small}/benchmark.parquet").select("text")))]
    rows = texts(stages["near_dedup"])
    spelled = dict(decontamination.rows(pa.array([t for _, t in rows])))
    leaked = {rows[at][0] for at, words in spelled.items() if any(holds(item, words) for item in items)}
    assert {i for i, _ in texts(stages["decontamination"])} == {i for i, _ in rows} - leaked and leaked


def column(docs):
    return docs.toArrow().column("text").combine_chunks()


def holds(item, words, threshold=decontamination.THRESHOLD):
    """By alignment with the whole text; only what has too few of the item's words is not aligned."""
    if np.isin(item, words).sum() < threshold * len(item):
        return False
    needed = threshold if decontamination.places_in_common(len(item), threshold) > 0 else 1
    return decontamination.align(item, words)[0] >= needed * decontamination.MATCH * len(item)


def test_packing_lays_out_every_id_once(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts(stages["decontamination"])}
    pieces = stages["packing"].collect()
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_document[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        part = np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4")
        assert zlib.crc32(part.tobytes()) == p.ids_crc32 and p.doc_tokens == len(ids[p.doc_id])
    assert set(by_document) == set(ids)
    for of, runs, place in ((by_document, lambda i: len(ids[i]), "start"), (by_sequence, None, "offset")):
        for name, found in of.items():
            end = 0
            for p in sorted(found, key=lambda p: p[place]):
                assert p[place] == end and p.length > 0
                end += p.length
            assert end == runs(name) if runs else end <= 1024


def test_run_gives_the_last_stage(llm, sf_small, stages):
    assert sorted(corpus_pipeline.run(llm, sf_small).collect()) == sorted(stages["packing"].collect())
