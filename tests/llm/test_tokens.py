"""Token operators against the libraries, packing by its invariants."""

import base64
import collections
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from limpid.llm.byte_bpe import RankDecoder, RankEncoder, Utf8Stream, decode, encode
from limpid.llm.chunks import LibraryEncoder
from limpid.llm.packing import Steps, pack_documents, step_groups
from limpid.llm.tables import Scratch
from limpid.llm.token_counts import CountCache, token_counts

RANKS, WORDS, BYTES = (P.path(n) for n in ("byte_bpe_50k.tiktoken", "word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["", " ", "  a b", "a  b\n c", "İstanbul ΣΑΣ ς", "a <|endoftext|> b<|endoftext|>", "don't we'll 'S", "\x1ca b", "a\xa0b \x85 c",
       "日本 語 テスト", "x \n", "\n x", "½ ²3 ª", "a b ", "😀 e😀", "aaaa " * 3000, "one two, three. four"]
ROWS = [(n, t) for n, t in enumerate(ODD)] + [(100, None), (100, None), (None, "no id"), (3, ODD[3])]


def docs(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "en", 1) for r in rows], "doc_id long, text string, ids string, offset int").repartition(3)


def random_texts():
    r = random.Random(1)
    return ["".join(r.choices(["th", "e", " ", " ", "\n", "é", "1", "'s", "!!", "日", "\t", "zq", ","], k=40)) for _ in range(300)]


@pytest.mark.parametrize("file", [WORDS, BYTES])
def test_chunks_match_the_library(file):
    library, ours = Tokenizer.from_file(file), LibraryEncoder(file)
    for text in ODD + random_texts():
        assert np.frombuffer(ours.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_transducer_matches_the_library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ours, back = RankEncoder(RANKS), RankDecoder(RANKS)
    for text in ODD + random_texts() + ["a" * n for n in range(1, 90, 7)]:
        ids = ours.ids(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert back.text(ids) == text


def test_utf8_stream_in_any_pieces():
    data = "aé日😀".encode() * 3 + b"\xff\xc3" + "z".encode() + b"\xf0\x9f"
    for size in range(1, 8):
        stream = Utf8Stream()
        text = "".join(stream.feed(data[n:n + size]) for n in range(0, len(data), size)) + stream.end()
        assert text == data.decode("utf-8", "replace")


def test_encode_decode_rows(spark):
    table = docs(spark).withColumnRenamed("ids", "other")
    out = decode(encode(table, "text", RANKS), "ids", RANKS).collect()
    assert sorted((r.doc_id or -1, r.decoded) for r in out) == sorted((i or -1, t or "") for i, t in ROWS)
    assert encode(table.limit(0), "text", RANKS).count() == 0
    with pytest.raises(ValueError):
        encode(docs(spark), "text", RANKS)


def test_counts_encode_misses_once(spark, tmp_path):
    cache, library = CountCache(spark, str(tmp_path / "cache")), Tokenizer.from_file(BYTES)
    want = sorted((i or -1, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS)
    for _ in range(2):
        got = token_counts(docs(spark), "doc_id", "text", BYTES, cache).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert spark.read.parquet(cache.folder).count() == len({t or "" for _, t in ROWS})
    assert token_counts(docs(spark).limit(0), "doc_id", "text", BYTES, CountCache(spark, str(tmp_path / "none"))).count() == 0


def test_pieces_cover_documents_and_sequences(spark):
    rows = ROWS + [(1000 + n, "word " * (n * 37 % 2900)) for n in range(120)]
    library = Tokenizer.from_file(WORDS)
    out = pack_documents(docs(spark, rows), "doc_id", "text", WORDS, pool_tokens=20000).collect()
    sequences, texts = {}, {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append(r)
        texts.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in pieces]).tolist()
        assert [r.offset for r in pieces] == [0, *ends[:-1]] and ends[-1] <= 2048
        assert ends[-1] & (ends[-1] - 1) == 0 and {r.context for r in pieces} == {ends[-1]}
    assert sum(r.length for r in out) == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    for n in range(0, 120, 9):
        want = library.encode(rows[len(ROWS) + n][1], add_special_tokens=False).ids + [1]
        pieces = sorted((r for r in out if r.doc_id == 1000 + n), key=lambda r: r.start)
        assert np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist() == want
        assert [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces]).tolist()[:-1]]
    assert pack_documents(docs(spark).limit(0), "doc_id", "text", WORDS).count() == 0
    assert Scratch(spark).root


def test_step_groups_are_full_and_balanced(spark):
    r = random.Random(9)
    rows = [(n, "word " * min(int(r.expovariate(1 / 500)), 9000)) for n in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    step = 16_384
    out = pack_documents(table, "doc_id", "text", WORDS, pool_tokens=150_000, step_tokens=step).collect()
    groups, tasks = {}, len({r.step_group >> 40 for r in out})
    for r in out:
        groups.setdefault(r.step_group, []).append(r)
    tokens = {g: sum(r.length for r in rows) for g, rows in groups.items()}
    short = [g for g in groups if tokens[g] < step]
    assert max(tokens.values()) == step and len(short) <= 5 * tasks and len(groups) > 3 * len(short)
    # whole groups hold windows of one size, at most one group of a tier and task is short
    assert all(len({r.context for r in groups[g]}) == 1 for g in groups if g not in short)
    assert all(n <= 1 for n in collections.Counter(
        (g >> 40, groups[g][0].context) for g in short if groups[g][0].context >= 256).values())
    cost = {}
    for g in set(groups) - set(short):
        cost.setdefault((g >> 40, groups[g][0].context), []).append(sum(r.length ** 2 for r in groups[g]))
    for found in cost.values():
        assert max(found) < 1.6 * min(found)
    sizes = {}
    for r in out:
        sizes.setdefault((r.sequence_id, r.step_group), []).append(r.length)
    assert len({s for s, _ in sizes}) == len(sizes)  # a sequence lies in one group


def test_groups_of_equal_windows_and_like_costs():
    assert sorted(collections.Counter(step_groups([5, 1, 9, 2, 7, 7, 3, 1], 4)).values()) == [2, 2, 2, 2]
    costs = [random.Random(3).randint(1, 1000) for _ in range(640)]
    total = collections.Counter()
    for c, g in zip(costs, step_groups(costs, 20)):
        total[g] += c
    assert max(total.values()) < 1.02 * min(total.values())
    steps = Steps(1000, 0, 0)  # what doesn't fill a group waits, then all odd sizes share one
    piece = [("d", 0, 100, b"", 100)]
    first = list(steps.add(100, [piece] * 23))
    assert collections.Counter(r[-1] for r in first) == {0: 10, 1: 10}
    rest = list(steps.add(64, [piece])) + list(steps.add(32, [piece])) + list(steps.close((100, 200)))
    assert collections.Counter(r[-1] for r in rest) == {2: 3, 3: 2} and len({r[5] for r in first + rest}) == 25
