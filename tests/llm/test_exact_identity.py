"""Texts that collide under polynomial hashes, newer letters, very long texts and empty tables."""

import base64
import random

import brute
import numpy as np
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def thue_morse(n=4096):
    """Two words that are each other's complement: equal under any polynomial hash modulo 2**64 with an odd base."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return ["".join("ab"[x ^ y] for x in bits) for y in (0, 1)]


@pytest.fixture(scope="module")
def tiktoken_like():
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers as P
    path = P.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return path, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_colliding_words_stay_apart(spark, tiktoken_like):
    from truetally.llm.bpe import encode_documents
    from truetally.llm.near_dup import near_duplicates
    from truetally.llm.quality import text_statistics
    from truetally.llm.repeats import remove_repeats
    path, ref = tiktoken_like
    a, b = thue_morse()
    tail = " ".join(f"w{i}" for i in range(40))
    docs = table(spark, [(1, a), (2, b), (3, f"{a} {b}"), (4, f"{a} " * 5 + tail), (5, f"{b} " * 5 + tail)])
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in encode_documents(docs, path, with_ids=True).collect():
        assert list(r.ids) == ref.encode_ordinary(texts[r.doc_id]) and r.decoded_sha256 == brute.sha(texts[r.doc_id])
    assert {r.doc_id: r.n_removed for r in remove_repeats(docs, window=5, seed=2).collect()} == {1: 0, 2: 0, 3: 0, 4: 40, 5: 40}
    assert {r.doc_id: r.component_id for r in near_duplicates(docs.where("doc_id < 3")).collect()} == {1: 1, 2: 2}
    raw = np.frombuffer(f"{a}\n{b}\n{a}".encode(), np.uint8)
    assert text_statistics(raw, np.array([0, len(raw)]))[0, 3] == 1


def test_code_points_of_all_kinds_are_split_as_tiktoken_does(tiktoken_like):
    from truetally.llm import bpe
    path, ref = tiktoken_like
    enc = bpe.Encoder(bpe.Ranks(path))
    rng = random.Random(0)
    points = [*rng.sample([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], 20_000), 0x105E7, 0x113A7, 0x134A7]
    texts = [f"a{chr(c)}a 1{chr(c)}1 {chr(c)}{chr(c)}" for c in points]
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    ids, at = enc.encode(np.frombuffer("".join(texts).encode(), np.uint8), off)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [ref.encode_ordinary(t) for t in texts]


def test_a_small_cache_gives_the_same_ids(tiktoken_like):
    from truetally.llm import bpe
    path, ref = tiktoken_like
    enc = bpe.Encoder(bpe.Ranks(path), cache_slices=20, cache_bytes=100)
    rng = random.Random(1)
    for _ in range(200):
        text = " ".join("".join(rng.choice("abcé'9") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 30)))
        raw = np.frombuffer(text.encode(), np.uint8)
        assert enc.encode(raw, np.array([0, len(raw)]))[0].tolist() == ref.encode_ordinary(text)


def test_megabyte_texts_and_empty_tables(spark, tiktoken_like):
    from truetally.llm.bpe import encode_documents
    from truetally.llm.repeats import remove_repeats
    from truetally.llm.runs import periodic_runs
    from truetally.llm.suffix_levels import remove_repeated_bytes
    path, ref = tiktoken_like
    rng = random.Random(2)
    half = " ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(80_000))
    rows = [(1, f"{half} x {half}"), (2, "short"), (3, None)]
    docs = table(spark, rows)
    n = len(half.split())
    assert {r.doc_id: (r.n_words, r.n_removed) for r in remove_repeats(docs).collect()} == {1: (2 * n + 1, 2 * n), 2: (1, 0), 3: (0, 0)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in remove_repeated_bytes(docs).collect()}
    assert got[1][0] == 2 * len(half) + 3 and got[1][1] in (2 * len(half), 2 * len(half) + 1, 2 * len(half) + 2) and got[1][2] == 2
    tokens = {r.doc_id: r.n_tokens for r in encode_documents(docs, path).collect()}
    assert tokens == {i: len(ref.encode_ordinary(t or "")) for i, t in rows}
    none = docs.limit(0)
    for out in (encode_documents(none, path), remove_repeats(none), remove_repeated_bytes(none), periodic_runs(none)):
        assert out.collect() == []
