"""The stages one after another, each against its operator's verdict on what it was given."""

import corpus_pipeline
from millrace.llm import decontamination, near_dedup, quality_rules
from millrace.session import store


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, given = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        given.append(docs)
        docs = store(stage(spark, docs, sf), name)
    assert all(d.columns == columns for d in given)
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in given]
    assert ids[1] == {r.doc_id for r in quality_rules.quality_rules(given[0]).where("kept").collect()}
    assert ids[2] == ids[1]
    assert ids[3] == {r.doc_id for r in near_dedup.near_dedup(given[2]).where("kept").collect()}
    leaks = decontamination.find_leaks(given[3], spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert ids[4] == ids[3] - {r.doc_id for r in leaks.collect()}
    assert {r.doc_id for r in docs.select("doc_id").collect()} == ids[4]


def one_of_each(rows, size, percent):
    """The ids that stay: the least of each group of linked texts."""
    sets = {n: {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} for n, w in rows}
    group = {n: n for n in sets}
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common) and group[a] != group[b]:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {n: new if g == old else g for n, g in group.items()}
    return set(group.values())


def test_near_dedup_stage(spark, sf):
    """Five words and 0.8: a paragraph added or scattered words changed, on both sides of the threshold."""
    rows = []
    for k in range(24):
        words = [f"w{k}x{i}" for i in range(200)]
        rows.append((3 * k, words))
        rows.append((3 * k + 1, words[:70] + [f"p{k}x{i}" for i in range(28 + k)] + words[70:]))
        rows.append((3 * k + 2, [f"c{k}" if i % 28 == 9 and i < 28 * (k % 8) else w for i, w in enumerate(words)]))
    docs = spark.createDataFrame([(n, " ".join(w)) for n, w in rows], "doc_id long, text string")
    got = {r.doc_id for r in corpus_pipeline.keep_one_of_each(spark, docs, sf).collect()}
    assert got == one_of_each(rows, 5, 80)
    assert got != one_of_each(rows, 3, 85)
