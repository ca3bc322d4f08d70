"""Near duplicates, resharding and the pipeline against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from limpid.llm.dart_minhash import near_duplicates, shingles, signatures, similarity, word_codes
from limpid.llm.embedding_neighbours import near_vectors
from limpid.llm.linking import components
from limpid.llm.queries import op9_sharding
from limpid.llm.sharding import (
    block_of, choose_blocks, min_cost_flow, plan_blocks, read_shards, reshard, rewrite_affected, slots_by_files,
    write_shards,
)
from limpid.llm.tables import Scratch


def classes(ids, links):
    above = {i: i for i in ids}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x
    for a, b in links:
        a, b = sorted((root(a), root(b)))
        above[b] = a
    return {i: root(i) for i in ids}


def test_components_of_chains_and_stars(spark):
    r = random.Random(0)
    edges = [(n, n + 1) for n in range(0, 40)] + [(100, n) for n in range(101, 160)] + [(300, 310), (305, 310), (305, 320)]
    r.shuffle(edges)
    out = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark), "t").collect()
    assert {x.id: x.component for x in out} == classes({v for e in edges for v in e}, edges)
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark), "e").count() == 0


def test_signature_agreement_is_the_similarity():
    draw = np.random.default_rng(1)
    items = np.unique(draw.integers(0, 2**63, 500).astype(np.uint64))
    one, two = (items[:400], draw.integers(1, 6, 400)), (items[100:], draw.integers(1, 6, len(items) - 100))
    made = signatures([one, two], 4000)
    assert abs((made[0] == made[1]).mean() - similarity(one, two)) < 0.03


def test_near_documents(spark):
    r = random.Random(3)
    base = [["w%d" % r.randint(0, 5000) for _ in range(r.randint(1, 120))] for _ in range(30)]
    rows = [(n, " ".join(w)) for n, w in enumerate(base)]
    for n in range(150):
        words = list(r.choice(base))
        for _ in range(r.randint(0, 4)):
            words[r.randrange(len(words))] = "new%d" % r.randint(0, 99)
        rows.append((1000 + n, " ".join(words)))
    rows += [(2000, None), (2001, ""), (2002, "..."), (None, rows[0][1]), rows[5], (2003, rows[5][1].upper())]
    table = spark.createDataFrame([(*x, "c") for x in rows], "doc_id long, text string, component_id string").repartition(4)
    out = near_duplicates(table, "doc_id", "text", Scratch(spark)).collect()
    made = {i: shingles(word_codes(t or "")) for i, t in rows if i is not None}
    links = [(a, b) for a in made for b in made if a < b and similarity(made[a], made[b]) >= 0.8]
    want = classes(set(made), links)
    assert len(out) == len(rows)
    assert {x.doc_id: x.component_id for x in out if x.doc_id is not None} == want
    assert all(x.kept == (x.doc_id is None or x.doc_id == want[x.doc_id]) for x in out)
    assert near_duplicates(table.limit(0), "doc_id", "text", Scratch(spark)).count() == 0


def test_letters_beyond_the_first_plane_count(spark):
    wide = [" ".join("".join(chr(base + (n * 7 + k * k) % 30) for k in range(3)) for n in range(20))
            for base in (0x20000, 0x1E900, 0x1D400)]
    for text in (*wide, "a\U0001F600b \U0010FFFFc", "\ud800x", "\uffff"):
        assert len(word_codes(text)) == len(re.findall(r"\w+", text.lower()))
    assert len({word_codes(chr(c)).tobytes() for c in range(0x20000, 0x20100)}) == 256
    rows = [(n, t) for n, t in enumerate(wide)] + [(10, wide[0]), (11, "same \U00020000"), (12, "same \U00020001")]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", Scratch(spark)).collect()
    assert {r.doc_id: r.component_id for r in out} == {0: 0, 1: 1, 2: 2, 10: 0, 11: 11, 12: 12}


def test_texts_of_one_id_are_judged_each(spark):
    r = random.Random(8)
    one, two, three, four = (" ".join("w%d" % r.randint(0, 9999) for _ in range(40)) for _ in range(4))
    rows = [(3, one, "a"), (7, one, "a"), (7, two, "a"), (7, three, "a"), (8, three + " more", "a"), (9, four, "b"), (9, four, "a"),
            (9, four.upper(), "a"), (5, "...", "a"), (5, "...", "a"), (5, None, "a"), (None, one, "a"), (6, two.upper(), "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = near_duplicates(docs, "doc_id", "text", Scratch(spark))
    assert sorted((x.doc_id, x.component_id, x.kept) for x in out.where("doc_id IN (3, 7)").collect()) == [
        (3, 3, True), (7, 3, False), (7, 6, False), (7, 7, True)]
    kept = sorted((tuple(x) for x in corpus_pipeline.near_dedup(spark, docs, "").collect()), key=repr)
    # of the id 9 one row: equal words, the smaller text by its MD5, then the smaller source
    nine = min(four, four.upper(), key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert kept == sorted([(3, one, "a"), (6, two.upper(), "c"), (7, three, "a"), (9, nine, "a"), (5, "...", "a"),
                           (5, "...", "a"), (5, None, "a"), (None, one, "a")], key=repr)


def test_near_vectors(spark):
    draw = np.random.default_rng(2)
    base = draw.normal(size=(40, 16))
    vectors = [v for v in base] + [base[n % 10] + draw.normal(size=16) * 0.12 for n in range(150)] + [base[0], base[0] * 3]
    rows = [(n, [float(x) for x in v]) for n, v in enumerate(vectors)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [None] + [1.0] * 15), (904, rows[1][1][:8]),
             (905, [float("inf")] * 16), (906, [])]
    out = near_vectors(spark.createDataFrame([(*x, 1) for x in rows], "vec_id long, v array<double>, id int"), "vec_id", "v",
                       Scratch(spark), recall=0.999).collect()
    x = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    want = classes([i for i, _ in rows], np.argwhere(near).tolist())
    assert {r.vec_id: r.component_id for r in out} == want
    assert {r.vec_id: r.n_links for r in out} == {i: int(near[i].sum()) if i < len(x) else 0 for i, _ in rows}


def test_vectors_of_one_id_are_judged_each(spark):
    draw = np.random.default_rng(6)
    one, two, three = (draw.normal(size=12) for _ in range(3))
    near = [one + draw.normal(size=12) * 0.05 for _ in range(30)]
    rows = [(7, one), (7, two), (7, two), (8, near[0]), (9, three), (3, two * 2.0)] + [(20 + n % 5, v) for n, v in enumerate(near[1:])]
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    rows += [(50, [float(x) for x in draw.normal(size=12)]) for _ in range(200)]  # one id on many vectors
    table = spark.createDataFrame(rows, "vec_id long, v array<double>").repartition(4)
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    row_class = classes(range(len(x)), np.argwhere(link).tolist())
    least = {c: min(rows[n][0] for n in range(len(x)) if row_class[n] == c) for c in set(row_class.values())}
    want = sorted((rows[n][0], int(link[n].sum()), least[row_class[n]], least[row_class[n]] == rows[n][0]) for n in range(len(x)))
    for bits in (26, None):
        out = near_vectors(table, "vec_id", "v", Scratch(spark), recall=0.9999, different_bits=bits).collect()
        assert sorted(tuple(r) for r in out) == want
    assert near_vectors(table.limit(0), "vec_id", "v", Scratch(spark)).count() == 0


@pytest.mark.parametrize("block", [1, 3, 16])
def test_links_by_angle_are_those_of_all_pairs(spark, block):
    """A tight group (all blocks sure), a chain that turns away from its head (far blocks), and groups in between."""
    draw = np.random.default_rng(9)
    base = draw.normal(size=(4, 8))
    vectors = [base[0] + draw.normal(size=8) * 0.02 for _ in range(40)]
    vectors += [np.cos(t) * np.eye(8)[0] + np.sin(t) * np.eye(8)[1] for t in np.arange(0, 2.6, 0.06)]
    vectors += [base[1] + draw.normal(size=8) * 0.25 for _ in range(40)] + [base[2]] * 5 + [base[2] * 2 + 1e-9] * 3
    rows = [(100 + n, [float(x) for x in v]) for n, v in enumerate(vectors)]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    want = classes([i for i, _ in rows], [(rows[a][0], rows[b][0]) for a, b in np.argwhere(link)])
    out = near_vectors(spark.createDataFrame(rows, "vec_id long, v array<double>").repartition(3), "vec_id", "v", Scratch(spark),
                       recall=0.99999, block=block).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == {
        i: (int(link[n].sum()), want[i]) for n, (i, _) in enumerate(rows)}


def test_scratch_tables_lie_in_shared_folders(spark):
    assert Scratch(spark).root.startswith(spark.conf.get("spark.checkpoint.dir"))
    unset = type("Session", (), {"conf": type("Conf", (), {"get": lambda self, k, *d: d[0] if d else "file:/home/warehouse"})()})()
    unset.sparkContext = type("Context", (), {"master": "local[2]"})()
    assert Scratch(unset).root.startswith("file:/home/warehouse/limpid-")
    unset.sparkContext.master = "spark://host:7077"
    with pytest.raises(ValueError):
        Scratch(unset)


def test_flow_moves_no_more_than_needed():
    r = random.Random(5)
    for _ in range(20):
        supply = [r.randint(0, 50) for _ in range(5)]
        demand = [sum(supply) // 4 + (n < sum(supply) % 4) for n in range(4)]
        flow = min_cost_flow(supply, demand, [[int(a != b) for b in range(4)] for a in range(5)])
        assert [sum(f) for f in flow] == supply and [sum(c) for c in zip(*flow)] == demand
        assert sum(f for a, row in enumerate(flow) for b, f in enumerate(row) if a != b) == sum(
            max(0, s - (demand[n] if n < 4 else 0)) for n, s in enumerate(supply))
    assert choose_blocks({}, 4) == {}


def test_reshard(spark):
    from pyspark.sql import functions as F
    rows = spark.range(3000).select(F.col("id"), (F.col("id") % 97 + 1).alias("size"), F.when(F.col("id") % 3 > 0, 0).otherwise(
        F.col("id") % 5).cast("int").alias("old"), F.lit("x").alias("slots")).withColumn("block", block_of(F.col("id")))
    out = reshard(rows.union(rows.limit(5)), "size", "old", "block", 8).collect()
    sizes, slots = {}, {}
    for r in out:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(out) == 3005 and max(sizes.values()) - min(sizes.values()) < 100
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert reshard(rows.limit(0), "size", "old", "block", 8).count() == 0
    with pytest.raises(ValueError):
        reshard(rows.withColumn("slot", F.lit(1)), "size", "old", "block", 8)


def test_rewriting_shards_keeps_every_row(spark, tmp_path):
    from pyspark.sql import functions as F
    rows = spark.range(2000).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 900).alias("k"), F.repeat(F.lit("t"), F.col("id").cast("int") % 5).alias("text"),
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 5).cast("int").alias("shard"))
    rows = rows.union(rows.limit(50))
    write_shards(rows, f"{tmp_path}/old")
    old = read_shards(spark, f"{tmp_path}/old", rows.schema, blocks=64)
    size = (F.length("text") + 1).alias("size")
    plan = plan_blocks(old.select(size, "shard", "_own"), "size", "shard", "_own", 5)
    new = slots_by_files(rewrite_affected(old, plan, f"{tmp_path}/new"))
    out = [(r.k, r.text, r.old_shard) for r in new.collect()]
    assert sorted(out, key=repr) == sorted(map(tuple, rows.collect()), key=repr) and any(r.k is None for r in new.collect())
    sizes = [r["sum(size)"] for r in new.select("shard", size).groupBy("shard").sum("size").collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) < 0.2 * max(sizes)
    slots = {}
    for r in new.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    still = plan_blocks(old.where("shard < 0").select(size, "shard", "_own"), "size", "shard", "_own", 5)
    assert rewrite_affected(old.where("shard < 0"), still, f"{tmp_path}/none").count() == 0


def test_a_row_repeated_in_a_third_of_the_table_is_spread(spark, tmp_path):
    docs = spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS doc_id", "CASE WHEN id % 3 = 0 THEN repeat('h', 200) "
                                        "WHEN id % 500 = 1 THEN NULL ELSE repeat('t', cast(id % 90 AS int)) END AS text",
                                        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 5) END AS source", "'x' AS slot")
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    out = op9_sharding(spark, str(tmp_path)).collect()
    sizes, slots = {}, {}
    for r in out:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(out) == 6000 and sum(r.doc_id == 7 and r.size == 201 for r in out) == 2000
    assert max(sizes.values()) - min(sizes.values()) < 1000 and len(sizes) == 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op9_sharding(spark, f"{tmp_path}/none").count() == 0


def test_sharding_query_reads_the_new_files(spark):
    sf = "/root/testdata/sf0.001"
    out = op9_sharding(spark, sf)
    assert any("new-shards" in f for f in out.inputFiles())
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = docs.selectExpr("doc_id", "crc32(cast(coalesce(text, '') as binary)) AS c")
    assert sorted((r.doc_id, r.text_crc32) for r in out.collect()) == sorted((r.doc_id, r.c) for r in want.collect())
    slots = {}
    for r in out.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_stages_keep_columns_and_clean_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        docs = Scratch(spark).keep(out, name)
    ids = {r.doc_id for r in docs.collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    long_enough = {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").where("n_chars > 1500").collect()}
    near = near_duplicates(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text", Scratch(spark)).where("kept")
    assert not {r.doc_id for r in near.collect()} & good & long_enough - ids
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids
