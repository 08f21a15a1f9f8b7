"""The pipeline: every stage's rows against a plainer reading of its own input."""
from __future__ import annotations

import os
import random
from collections import Counter

import pytest
from pyspark.sql import GroupedData

import corpus_pipeline
from growthloom.llm import contamination, jaccard, mixing

EXTRA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_hand_on_the_columns_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES:
        before = docs
        docs = step(spark, before, sf).cache()
        assert docs.count() > 0, name
        if name != "sharding":
            assert docs.columns == columns, name
        ids = {r["doc_id"] for r in before.select("doc_id").collect()}
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} <= ids
        if name == "near copies":
            found = jaccard.jaccard_components(before, words=5, percent=80)
            assert docs.count() == found.select("component_id").distinct().count()
        if name == "decontamination":
            items = spark.read.parquet(f"{sf}/benchmark.parquet")
            assert docs.count() == before.count() - contamination.contaminated(before, items).where("contaminated").count()
        if name == "mixing":
            assert docs.count() == mixing.mix(before).agg({"copies": "sum"}).first()[0]
    assert {"shard", "slot"} <= set(docs.columns)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", None, None, 0), (2, "a b c", "en", "s", 5), (2, "a b c", "en", "s", 5), (3, "A b c", "en", None, 5)]])
def test_stages_take_nulls_repeats_and_empty_tables(spark, frame, sf, rows):
    docs = frame(rows, EXTRA)
    kept = Counter()
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, sf)
        kept[name] = out.count()
        assert out.columns[:5] == docs.columns
    assert kept["near copies"] == (3 if rows else 0) and kept["sharding"] == len(rows)


def near_copy_groups(rows, words=5, percent=80):
    """Groups of row numbers that all pairs link."""
    def shingles(text):
        w = text.lower().split()
        return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()

    sets = [shingles(t or "") for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= percent * len(a | b):
                group = [group[j] if g == group[i] else g for g in group]
    return group


def test_near_copies_against_all_pairs_at_five_words(spark, frame, sf):
    rng = random.Random(4)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 20, 60, 100]))]
        for changes in (0, 1, 2, 2, 3, 6):
            copy = list(base)
            for at in rng.sample(range(len(base)), min(changes, len(base))):
                copy[at] = f"x{rng.randrange(5000)}"
            texts.append(" ".join(copy))
    base = [f"a{i}" for i in range(100)]  # two words apart: 86 of 106 shingles of five words, 92 of 104 of three
    texts += [" ".join(base), " ".join("z" if i in (20, 50) else w for i, w in enumerate(base))]
    order = rng.sample(range(len(texts)), len(texts))
    rows = [(i, texts[k]) for i, k in enumerate(order)]
    rows += [(5, "another text of the same id that is like no other one"), (6, None)]
    rows = list(dict.fromkeys(rows))
    smallest = {}
    for (i, _), g in zip(rows, near_copy_groups(rows), strict=True):
        smallest[g] = min(smallest.get(g, i), i)
    rows.append((6, None))
    out = corpus_pipeline.near_copies(spark, frame([(i, t, "en", "s", 1) for i, t in rows], EXTRA), sf).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(smallest.values())


def test_stages_keep_columns_whose_names_the_operators_use(spark, frame, sf):
    names = "size string, score string, n_words string, lang_pred string, contaminated string, copies string, shard string, items string, `a.b` string"
    texts = ["the first of all texts is about a house and a river", "the second text tells of a tree near the old mill", "x " * 9000, "the second text tells of a tree near the old mill"]
    docs = frame([(i, t, "en", "s", 1, *"abcdefghi") for i, t in enumerate(texts)], f"{EXTRA}, {names}")
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, sf)
        if name == "sharding":
            assert {"shard", "slot", "input_shard"} <= set(out.columns)
            assert {r["input_shard"] for r in out.collect()} == {"g"}
        else:
            assert out.columns == docs.columns, name
            got = out.collect()
            assert got and all(tuple(r)[5:] == tuple("abcdefghi") for r in got), name


def test_near_copies_shuffle_a_part_at_a_time(spark, frame, monkeypatch, tmp_path):
    """The joins of fragments, overlaps and blocks: the shuffle files of one written table stay near what all sets hold."""
    rng = random.Random(9)
    texts = []
    for _ in range(150):
        base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        texts += [" ".join(f"x{rng.randrange(10**6)}" if i in at else w for i, w in enumerate(base)) for n in (0, 3, 3, 15, 15, 15) for at in [rng.sample(range(300), n)]]
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    written = []

    def shuffled():
        return {f: os.path.getsize(f) for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f and os.path.exists(f)}

    def kept(df, name, compression="snappy"):
        before = shuffled()
        df.write.parquet(path := str(tmp_path / str(len(written))))
        written.append((name, sum(size for f, size in shuffled().items() if f not in before)))
        return spark.read.schema(df.schema).parquet(path)

    monkeypatch.setattr(jaccard, "stage", kept)
    docs = frame(list(enumerate(texts)), "doc_id long, text string")
    found = jaccard.jaccard_components(docs, words=5, percent=80)
    assert found.select("component_id").distinct().count() < len(texts)
    sets = 8 * found.agg({"n_shingles": "sum"}).first()[0]
    assert max(b for _, b in written) < 1.5 * sets


def test_blocks_of_a_group_do_not_grow_with_its_square(spark, frame, monkeypatch):
    """Of copies too far from their hub, and of documents around one passage, only those that may link are compared."""
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rows, compare = [], GroupedData.applyInArrow

    def counted(self, func, schema):
        rows.append(self._df.select("hub", "i", "j", "node", "left").distinct().count())
        return compare(self, func, schema)

    monkeypatch.setattr(GroupedData, "applyInArrow", counted)
    rng = random.Random(6)

    def changed(words, n):
        at = set(rng.sample(range(len(words)), n))
        return [f"x{rng.randrange(10**9)}" if i in at else w for i, w in enumerate(words)]

    base, passage = [f"w{i}" for i in range(120)], [f"p{i}" for i in range(60)]
    texts = [base]
    for _ in range(150):
        texts += [changed(base, 1), changed(base, 7), passage + [f"y{rng.randrange(10**9)}" for _ in range(rng.randrange(60, 90))]]
    far = texts[2::30]  # their copies link with them, some with copies of copies only
    texts += [changed(t, 1) for t in far] + [changed(changed(t, 1), 2) for t in far] + [t[:100] for t in texts[3::60]]
    rng.shuffle(texts)
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(frame(docs, "doc_id long, text string"), words=5, percent=80).collect()}
    assert sum(rows) < 4 * len(docs)
    group, smallest = near_copy_groups(docs), {}
    for i, g in enumerate(group):
        smallest.setdefault(g, i)
    assert got == {i: smallest[g] for i, g in enumerate(group)}
