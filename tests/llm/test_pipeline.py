"""The corpus pipeline: each stage over a small corpus with known cases, and over odd rows."""

import random

import corpus_pipeline as pipeline
from lineara import session
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def made(spark, tmp_path):
    rng = random.Random(4)
    kinds = {"en": ["the", "ing", "tion", "er", "and"], "de": ["sch", "ung", "keit", "ver", "ich"]}
    word = lambda lang: "".join(rng.choice(kinds[lang]) for _ in range(rng.randint(1, 4)))
    text = lambda lang, n: "\n".join(" ".join(word(lang) for _ in range(15)) for _ in range(n))
    rows = [(k, text(lang, 8), lang, f"s{k % 3}") for k, lang in enumerate(["en", "de"] * 30)]
    passage, item = text("en", 5), " ".join(word("en") for _ in range(20))
    rows[10] = (10, rows[10][1] + "\n" + passage, "en", "s0")
    rows[20] = (20, passage + "\n" + rows[20][1], "en", "s1")
    rows.append((100, rows[5][1], "de", "s0"))
    words = rows[6][1].split(" ")
    words[40] = "changed"
    rows.append((101, " ".join(w + "x" * (k % 45 == 44) for k, w in enumerate(words)), "en", "s0"))
    rows.append((102, rows[8][1] + "\nbefore " + item.upper() + " after", "en", "s2"))
    rows += [(103, "12345 ... 678", None, None), (104, None, "en", None), (None, text("de", 3), None, "s9")]
    (tmp_path / "x").mkdir()
    spark.createDataFrame([("i1", item)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    return passage, item


def test_stages(spark, tmp_path):
    passage, item = made(spark, tmp_path)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet")).withColumn("_id", F.lit("clash")).withColumn("score", F.lit(1)).withColumn("spans", F.lit(2))
    seen = {}
    for name, stage in pipeline.STAGES:
        before = docs
        stage(spark, before, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r.doc_id: r for r in docs.collect()}
        if name != "packing":
            assert docs.columns == pipeline.COLUMNS
    assert not {103, 104} & set(seen["language"]) and set(range(60)) <= set(seen["language"]) and None in seen["language"]
    assert passage in seen["line_dedup"][10].text and not any(x in seen["line_dedup"][20].text for x in passage.split("\n")) and 100 not in seen["line_dedup"]
    assert seen["line_dedup"][20].n_chars == len(seen["line_dedup"][20].text)
    assert set(range(60)) <= set(seen["near_duplicates"]) and 102 in seen["near_duplicates"]
    assert item.split(" ")[3] + " " not in seen["decontamination"][102].text.lower() or item not in seen["decontamination"][102].text.lower()
    assert "before" in seen["decontamination"][102].text and "after" in seen["decontamination"][102].text
    assert sum(r.length for r in docs.collect()) == sum({r.doc_id: r.doc_tokens for r in docs.collect()}.values())


def test_near_duplicates_leave_one(spark):
    rng = random.Random(8)
    words = [f"{rng.randrange(10**6)}" for _ in range(300)]
    rows = [(k, " ".join(words[: 40 + k] + [f"new{k}"] + words[41 + k :])) for k in range(6)] + [(9, "of its own"), (9, "of its own"), (None, "of its own")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    left = pipeline.dedup_near(spark, docs, "").collect()
    assert sorted((r.doc_id for r in left), key=lambda x: (x is None, x)) == [0, 9, None]


def test_odd_rows_and_empty_tables(spark, odd, none, tmp_path):
    spark.createDataFrame([], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (odd, none):
        for _, stage in pipeline.STAGES:
            stage(spark, docs, str(tmp_path)).collect()


def test_run(spark, sf, tmp_path):
    before = len(session.MADE)
    got = pipeline.run(spark, sf)
    names = [m.rsplit("-", 1)[-1] for m in session.MADE[before:]]
    assert "decontamination" in names and not {"chunks", "fingerprints", "line_dedup"} & set(names)
    for table, schema in (("documents", SCHEMA), ("benchmark", "item_id string, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
    assert got.count() > 0 and {"doc_id", "sequence_id", "offset", "length"} <= set(got.columns)
