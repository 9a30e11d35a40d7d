import uuid

import pytest
from llm_texts import words

import corpus_pipeline
from contrail.session import ensure_checkpoint_dir
from test_minhash import brute as near_classes
from test_mixture import brute as mixed
from test_quality import statistics
from test_words_substring import brute as cut

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stored(spark, df):
    path = f"{ensure_checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def rows_of(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "substring_dedup", "benchmark_decontamination", "mixture"]
    before = rows_of(docs)

    kept = stored(spark, stages["quality_rules"](spark, docs, SF))
    assert kept.columns == COLUMNS
    after = rows_of(kept)
    sound = {r[0] for r in before if not (statistics(r[1])[0] < 10 or 100 * statistics(r[1])[4] > 20 * statistics(r[1])[0])}
    assert {r[0] for r in after} <= sound and set(after) <= set(before)
    plain = {r[0] for r in before if r[0] in sound and statistics(r[1])[2] == 0}
    assert plain <= {r[0] for r in after}  # clean documents stay

    single = stored(spark, stages["near_duplicates"](spark, kept, SF))
    assert sorted(r[0] for r in rows_of(single)) == sorted(d for d, c in near_classes(after) if d == c)

    trimmed = stored(spark, stages["substring_dedup"](spark, single, SF))
    want = cut(rows_of(single), 13)
    got = {r[0]: r[1] for r in rows_of(trimmed)}
    assert trimmed.columns == COLUMNS and {d: len(words(t)) for d, t in got.items()} == {d: n - gone for d, n, gone, _ in want}
    assert all(r["n_chars"] == len(r["text"]) for r in trimmed.collect())
    untouched = {d for d, _, gone, _ in want if not gone}
    assert all(got[r[0]] == r[1] for r in rows_of(single) if r[0] in untouched)

    clean = stored(spark, stages["benchmark_decontamination"](spark, trimmed, SF))
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {r[0] for r in rows_of(trimmed) if any(i in r[1] for i in items)}
    left = {r[0] for r in rows_of(clean)}
    assert not held & left and len(left) >= len(got) - len(held) - 2

    mix = stages["mixture"](spark, clean, SF)
    assert sorted((tuple(r)[:4] + (round(r["target"], 4), r["taken"]) for r in mix.collect()), key=repr) == mixed(rows_of(clean))


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.where("taken > 0").count() > 20


@pytest.mark.parametrize("rows", ["hard", "none"])
def test_every_stage_takes_any_table(spark, hard_docs, no_docs, rows):
    docs = hard_docs if rows == "hard" else no_docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "mixture":
            assert out.columns == docs.columns, name
        assert out.count() <= docs.count(), name
        if name == "near_duplicates" and rows == "hard":
            assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] in (1, 2, 3)) == [1]


def test_near_duplicates_spares_other_texts_of_an_id(spark):
    """Of an id with two texts only the copy goes; a third text under a null id stays."""
    t, u, v = (" ".join(f"{c}{i}" for i in range(40)) for c in "tuv")
    docs = spark.createDataFrame([(1, t), (2, t), (2, u), (None, v), (3, v)], "doc_id long, text string")
    out = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, t), (2, u), (None, v), (3, v)], key=repr)
