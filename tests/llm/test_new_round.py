"""Language codes, fill-in-the-middle and the Merkle manifest against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from limpid.llm import language_codes, merkle
from limpid.llm.fill_in_middle import Units, draws, fill_in_middle, restored
from limpid.llm.queries import op11_language_codes, op12_fill_in_middle, op13_merkle_manifest
from limpid.llm.tables import Scratch

SF = "/root/testdata/sf0.001"


# ---- fill in the middle

def lines_of(text):
    return re.findall(r"[^\n]*\n|[^\n]+", text)


def test_units_end_where_the_lines_do():
    r = random.Random(1)
    for _ in range(400):
        text = "".join(r.choices(["a", "é", "\n", "\U0001D4B3", "漢"], weights=[5, 2, 2, 1, 1], k=r.randint(0, 60)))
        units, lines = Units(text.encode(), block=r.choice([1, 3, 7, 16])), lines_of(text)
        assert units.count == len(lines)
        for k in range(len(lines) + 1):
            head = "".join(lines[:k])
            assert units.end(k) == (len(head.encode()), len(head))


def expected_cut(doc_id, text, rate=100, share=50):
    text, lines = text or "", lines_of(text or "")
    one, two, chance, order = (int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[k:k + 8], 16)
                               for k in (0, 8, 16, 24))
    if not text or chance % 100 >= rate or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(lines), "plain", None, None, text
    a, b = sorted((one % (len(lines) + 1), two % (len(lines) + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    form = "spm" if order % 100 < share else "psm"
    return len(lines), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(spark):
    r = random.Random(2)
    texts = [None, "", "\n", "\n\n\n", "no end", "a <P> b\nc", "<S", "<", ">\n<", "é\n" * 3, "x\r\ny", "line\n" * 30_000, "w " * 200_000]
    texts += ["".join(r.choices(["ab ", "é", "\n", "<", ">", "P", "S", "\U0001D4B3"], k=r.randint(1, 80))) for _ in range(150)]
    rows = [(n if n else None, t, 0, "p") for n, t in enumerate(texts)] + [(9, texts[9], 0, "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, output_in string").repartition(3)
    for rate, share in ((100, 50), (60, 0)):
        out = fill_in_middle(docs, "doc_id", "text", rate=rate, suffix_first=share)
        assert out.columns == ["doc_id", "text", "n_in", "output_in", "n", "form", "prefix_chars", "middle_chars", "output"]
        out = out.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
        assert len(out) == len(rows) and {x.form for x in out} >= {"plain", "psm"}
        for x in out:
            assert (x.n, x.form, x.prefix_chars, x.middle_chars, x.output) == expected_cut(x.doc_id, x.text, rate, share)
            assert x.back == (x.text or "") and x.n_in == 0
    assert fill_in_middle(docs.limit(0), "doc_id", "text").count() == 0
    with pytest.raises(ValueError):
        fill_in_middle(docs, "doc_id", "text", markers=("<P>", "<P>", "M"))
    assert draws(7, "12") == [int(hashlib.sha256(b"7:12").hexdigest()[k:k + 8], 16) for k in (0, 8, 16, 24)]


def test_fill_in_middle_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = op12_fill_in_middle(spark, SF).collect()
    assert len(out) == len(docs)
    for x in out:
        *numbers, text = expected_cut(x.doc_id, docs[x.doc_id])
        assert [x.n, x.form, x.prefix_chars, x.middle_chars] == numbers
        assert x.output_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert x.restored_sha256 == hashlib.sha256(docs[x.doc_id].encode()).hexdigest()


# ---- Merkle manifest

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def paths(digests):
    """Root, and for every leaf the (own place, others) of its runs, level by level."""
    found, owner, nodes = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(nodes) > 1:
        for leaf, own in enumerate(owner):
            run = nodes[own // 8 * 8:own // 8 * 8 + 8]
            found[leaf].append((own % 8, run[:own % 8] + run[own % 8 + 1:]))
        nodes = [H(*nodes[k:k + 8]) for k in range(0, len(nodes), 8)]
        owner = [own // 8 for own in owner]
    return nodes[0] if nodes else None, found


def fold(digest, path):
    for place, others in path:
        digest = H(*others[:place], digest, *others[place:])
    return digest


def expected_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, H(*map(framed, r)), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: paths([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    root, upper = paths([trees[g][0] for g in order])
    out = []
    for g, above in zip(order, upper):
        subroot, below = trees[g]
        for (_, _, leaf, r), path in zip(sorted(groups[g], key=lambda x: x[:3]), below):
            path = path + above
            started = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                text = None if r[4] is None else re.sub("[A-Z]", lambda m: m[0].lower(), r[4])
                started = H(*map(framed, (*r[:4], text)))
            out.append((r[0], leaf, subroot, root, H(*itertools.chain(*(others for _, others in path))), fold(started, path)))
    return out


def manifest_rows(spark, rows, tmp_path, partitions=3):
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, leaf int, tree string") \
        .repartition(partitions).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return [(x.doc_id, x.leaf, x.subroot, x.root, x.proof_sha256, x.folded_root)
            for x in op13_merkle_manifest(spark, str(tmp_path)).collect()]


def test_manifest(spark, tmp_path):
    r = random.Random(4)
    sizes = {"en": 70, "de": 9, "fr": 8, "ab": 1, None: 65, "zz": 2, "é": 3, "": 1, "-": 1}
    rows = [(r.randint(0, 10**6), f"src{r.randint(0, 3)}", lang, r.randint(0, 9), r.choice(["Ab é", None, "", "x" * 3000, "ZZ\n"]))
            for lang, n in sizes.items() for _ in range(n)]
    hot = rows[0]
    rows += [hot] * 60 + [(hot[0], None, "en", None, f"Other {n}") for n in range(30)] + [(None, None, None, None, None)] * 2
    r.shuffle(rows)
    got = manifest_rows(spark, [(*x, 1, "t") for x in rows], tmp_path)
    assert sorted(got, key=repr) == sorted(expected_manifest(rows), key=repr)
    verified = op13_merkle_manifest(spark, str(tmp_path)).collect()
    assert all(x.verified == (x.folded_root == x.root) for x in verified) and {x.verified for x in verified} == {True, False}


@pytest.mark.parametrize("rows", [[], [(1, "s", None, 1, "A")], [(n, "s", str(n), 1, "Ab") for n in range(12)]])
def test_small_manifests(spark, tmp_path, rows):
    got = manifest_rows(spark, [(*x, 1, "t") for x in rows], tmp_path, 1)
    assert sorted(got) == sorted(expected_manifest(rows))


def test_manifest_finds_a_change_and_names_subroots(spark):
    docs = spark.range(100).selectExpr("id AS leaf", "concat('t', id) AS text", "cast(id % 3 AS string) AS g")
    made = merkle.manifest(docs, "leaf", "g", merkle.leaf_digest(F.col("leaf"), F.col("text")), Scratch(spark))
    assert made.rows.columns == ["leaf_in", "leaf", "subroot", "root", "path"]
    assert {x.g for x in made.subroots.collect()} == {"0", "1", "2"}
    assert {x.f for x in made.rows.select(merkle.folded(F.col("leaf"), F.col("path")).alias("f")).collect()} == {made.root}
    changed = merkle.manifest(docs.withColumn("text", F.when(F.col("leaf") == 57, "x").otherwise(F.col("text"))), "leaf", "g",
                              merkle.leaf_digest(F.col("leaf"), F.col("text")), Scratch(spark))
    other = {x.g: x.subroot for x in changed.subroots.collect()}
    assert changed.root != made.root and [x.g for x in made.subroots.collect() if other[x.g] != x.subroot] == ["0"]


# ---- language codes

def speech(r, letters, n):
    return " ".join("".join(r.choices(letters, k=r.randint(2, 8))) for _ in range(n))


LETTERS = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "ijklmnop", "dd": "aeiounst"}


def test_codewords_differ():
    for n in (2, 3, 4, 6, 7, 20, 90):
        code = language_codes.codewords(n)
        apart = language_codes._distances(code, code)[~np.eye(n, dtype=bool)]
        assert apart.min() >= (1 if n < 3 else 2 if n < 4 else 4) and set(np.unique(code)) <= {-1.0, 1.0}
        assert (np.abs(code.sum(axis=0)) < n).all()  # no bit is the same for all
    assert language_codes.codewords(4).shape == (4, 7) and language_codes.codewords(1).shape == (1, 0)


def test_decoding_is_the_least_weighted_loss_and_corrects_a_bit():
    code = language_codes.codewords(4)
    draw = np.random.default_rng(3)
    weights = draw.uniform(0.2, 1, size=code.shape)
    weights /= weights.sum(axis=1, keepdims=True)
    codes = language_codes.Codes(list("abcd"), code, np.zeros((4096, 7)), np.zeros(7), weights)
    values = draw.normal(size=(200, 7)) * 2
    best, second, share, _ = codes.decode(values)
    for v, b, s, p in zip(values, best, second, share):
        losses = [sum(w * np.log1p(np.exp(-m * x)) for w, m, x in zip(ws, row, v)) for ws, row in zip(weights, code)]
        assert b == int(np.argmin(losses)) and s == int(np.argsort(losses)[1])
        odds = np.exp(-np.array(losses) * 7)
        assert abs(p - odds[b] / odds.sum()) < 1e-9
    even = language_codes.Codes(list("abcd"), code, np.zeros((4096, 7)), np.zeros(7), np.full(code.shape, 1 / 7))
    for k, row in enumerate(code):
        for bit in range(7):
            wrong = row * 3.0
            wrong[bit] = -wrong[bit]
            assert even.decode(wrong[None])[0][0] == k and not even.decode(wrong[None])[3][0]
    assert even.decode(np.zeros((1, 7)))[3][0]  # nothing speaks for any language


def test_counts_are_those_of_whole_texts(monkeypatch):
    text = "Ab  cé, d\n" * 40 + "Ünïx"
    whole = language_codes.ngram_counts(text)
    letters = " " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " "
    assert whole.sum() == 3 * len(letters) - 3
    assert (language_codes.ngram_counts(text.upper().replace(" ", "...7")) == whole).all()
    monkeypatch.setattr(language_codes, "SLAB", 50)
    assert np.abs(language_codes.ngram_counts(text) - whole).sum() < 0.3 * whole.sum()
    late = language_codes.ngram_counts(text + "qqq") - language_codes.ngram_counts(text)
    assert late.sum() > 0  # the last slab counts


def test_language_identification(spark):
    r = random.Random(5)
    rows = [(n, speech(r, LETTERS[lang], r.randint(3, 60)), lang, 1.0) for n, lang in
            enumerate(r.choices(list(LETTERS), weights=[60, 25, 10, 5], k=500))]
    hot = [(9999, rows[0][1], "bb", 1.0)] * 300  # one wrongly labelled text on a third of the rows
    odd = [(None, None, "aa", 1.0), (5001, "", None, 1.0), (5002, "12 ½ ²!", "bb", 1.0), (5003, "abc " * 50_000, None, 1.0)]
    docs = spark.createDataFrame(rows + hot + odd, "doc_id long, text string, lang string, score double").repartition(4)
    learn = F.col("doc_id") % 4 != 2
    codes = language_codes.fit(docs, "text", "lang", learn)
    assert codes.languages == list(LETTERS)
    out = language_codes.identify(docs, "text", codes)
    assert out.columns == ["doc_id", "text", "lang", "score_in", "lang_pred", "score", "runner_up", "ambiguous"]
    found = out.collect()
    assert len(found) == len(rows) + len(hot) + len(odd)
    held = [x for x in found if x.doc_id is not None and x.doc_id < 5000 and x.doc_id % 4 == 2]
    assert np.mean([x.lang_pred == x.lang for x in held]) > 0.97
    assert all(0 <= x.score <= 1 and x.runner_up != x.lang_pred for x in found)
    assert [(x.lang_pred, x.score) for x in found if x.doc_id in (None, 5001, 5002)] == [("und", 0.0)] * 3
    assert [x.lang_pred for x in found if x.doc_id == 5003] == ["aa"]
    mixed = spark.createDataFrame([(1, speech(r, LETTERS["bb"], 40) + " " + speech(r, LETTERS["cc"], 40))], "k int, text string")
    clear = np.mean([x.ambiguous for x in held])
    assert clear < 0.1 and language_codes.identify(mixed, "text", codes).first().lang_pred in ("bb", "cc")
    assert language_codes.identify(docs.limit(0), "text", codes).count() == 0


def test_few_languages_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc def", "aa"), (2, None, "bb"), (3, "12", "cc"), (4, "xyz", None)], "k long, text string, lang string")
    one = language_codes.fit(docs, "text", "lang", F.lit(True))
    assert [(x.lang_pred, x.score, x.runner_up) for x in language_codes.identify(docs, "text", one).orderBy("k").collect()] == [
        ("aa", 1.0, None), ("und", 0.0, None), ("und", 0.0, None), ("aa", 1.0, None)]
    none = language_codes.fit(docs.limit(0), "text", "lang", F.lit(True))
    assert {x.lang_pred for x in language_codes.identify(docs, "text", none).collect()} == {"und"}
    two = language_codes.fit(docs.union(docs.selectExpr("k + 9", "concat(text, ' qqq rrr')", "concat(lang, '2')")), "text", "lang",
                             F.lit(True), languages=1)
    assert two.languages == ["aa"]


def test_language_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = op11_language_codes(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [x for x in out if x.held_out]
    assert len(out) == 1000 and all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in out)
    assert np.mean([x.lang_pred == x.lang for x in held]) > 0.93
