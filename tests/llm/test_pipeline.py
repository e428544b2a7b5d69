"""Every stage of the corpus pipeline on planted rows: nulls, repeats, empty tables, clashing columns, a very long text."""

import random
from collections import Counter

import pytest
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline as p
from fraudflow.llm import packing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _k1 int, row string, count int, id string, k1 string, named string"


def rows():
    rng = random.Random(11)
    own = lambda n=60: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    base, long = own(), " ".join(f"x{i}" for i in range(180_000))  # over a million characters
    made = [(1, own()), (2, None), (3, ""), (None, own()), (None, own()), (4, base), (5, base + " more"), (6, "a@b.org wrote " + own()), (7, long), (8, own())]
    return [(i, t, "en", "src", len(t or ""), n, "r", n, "id", "k", "m") for n, (i, t) in enumerate(made)]


@pytest.fixture(scope="module")
def docs(spark):
    held = rows()
    # the last row twice, and once with other columns
    return spark.createDataFrame([*held, held[-1], (*held[-1][:5], -7, "r", -7, "id", "k", "m")], SCHEMA)


@pytest.mark.parametrize("name", [n for n, _ in p.STAGES])
def test_stage_keeps_columns_and_clean_rows(spark, docs, name):
    stage = dict(p.STAGES)[name]
    out = stage(spark, docs, SF)
    held = docs.collect()
    assert stage(spark, docs.limit(0), SF).count() == 0
    if name == "packing":
        found = out.collect()
        places = Counter(r.doc_id for r in found if r.piece == 0)
        assert places == Counter(r.doc_id for r in held) and sum(r.length for r in found if r.doc_id == 7) > 180_000
        return
    assert out.columns == docs.columns
    got = out.collect()
    if name == "near_duplicates":
        # null and empty are one class, the near copy goes, of the repeats the least row stays
        assert sorted((r.doc_id or 0 for r in got)) == [0, 0, 1, 2, 4, 6, 7, 8] and [r["_k1"] for r in got if r.doc_id == 8] == [-7]
        assert {r for r in got} <= set(held)
    elif name == "pii":
        assert Counter((r.doc_id, r["count"]) for r in got) == Counter((r.doc_id, r["count"]) for r in held)
        changed = [r for r in got if r not in held and r.text is not None]
        assert [r.doc_id for r in changed] == [6] and "a@b.org" not in changed[0].text and all(r.n_chars == len(r.text) for r in changed)
    else:  # a null text is empty from the first stage on
        plain = lambda found: Counter((*r[:1], r.text or "", *r[2:]) for r in found)
        assert plain(got) == plain(held)


def test_toxic_rows_go(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    some = docs.join(labels, "doc_id").where("doc_id < 3000")
    want = {r.doc_id: r.toxic for r in some.collect()}
    left = {r.doc_id for r in p.drop_toxic(spark, docs, "/root/testdata/sf0.1").where("doc_id < 3000").select("doc_id").collect()}
    assert sum((i in left) != (t == 1) for i, t in want.items()) > 0.95 * len(want)


def test_run_applies_all_stages(spark):
    out = p.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    want = packing.pack_documents(docs)
    key = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(out) == key(want) and out.where(F.col("doc_id").isNull()).count() == 0
