"""The pipeline against a brute-force version of its stages."""

import brute


def test_pipeline_matches_brute_force(spark, sf):
    import corpus_pipeline as cp
    from truetally.llm.line_dedup import MIN_SITES
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    out = docs
    for _, stage in cp.STAGES[:1]:
        out = stage(spark, out, sf)
    kept = sorted(r.doc_id for r in out.collect())
    # stage 1: the base rule, and symbols for the outlier rule (its estimate has tests of its own)
    def plain(text):
        w = brute.words(text)
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        seen = {}
        for g in grams:
            seen[g] = seen.get(g, 0) + 1
        covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
        noisy = sum(c in "#*$%&|<>" for c in text) > 0.05 * sum(map(len, w))
        return len(w) >= 50 and 100 * len(covered) <= 50 * len(w) and not noisy
    assert kept == sorted(i for i, r in rows.items() if plain(r.text))
    # stage 2
    left = {i: rows[i].text for i in kept}
    sites, first = {}, {}
    for i in kept:
        for line in left[i].split("\n"):
            if line.strip(" "):
                sites.setdefault(line, set()).add(rows[i].source)
                first[line] = min(first.get(line, i), i)
    gone = {x for x, s in sites.items() if len(s) >= MIN_SITES}
    left = {i: "\n".join(x for x in t.split("\n") if x not in gone or first[x] == i) for i, t in left.items()}
    # stage 3
    left = {i: left[i] for i, _, _, ok in brute.near_groups(list(left.items())) if ok}
    # stage 4
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {i for i, _ in brute.leaks(list(left.items()), items)}
    left = {i: t for i, t in left.items() if i not in bad}
    got = {r.doc_id: r.decoded_sha256 for r in cp.run(spark, sf).collect()}
    assert got == {i: brute.sha(t) for i, t in left.items()}


def test_stages_keep_columns_and_pass_empty_tables(spark, sf):
    import corpus_pipeline as cp
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0).withColumn("score", F.lit(1)).withColumn("id", F.lit("x"))
    for name, stage in cp.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0
        if name != cp.STAGES[-1][0]:
            assert out.columns == docs.columns
