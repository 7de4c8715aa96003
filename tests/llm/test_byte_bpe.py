"""Byte-level BPE against the other library over the same ranks, and exact round trips."""

from __future__ import annotations

import random

import numpy as np
import pytest

from daytally.llm import byte_bpe, queries
from tests.conftest import SF001, SF01
from tests.llm import brute

tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
OWN = {"path": tokenizers.path("byte_bpe_multi_50k.tiktoken"), "pattern": tokenizers.PATTERN}


@pytest.fixture(scope="module")
def other():
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(OWN["path"]), special_tokens={})


@pytest.fixture(scope="module")
def own():
    return byte_bpe.Codec(**OWN)


def agree(own, other, texts):
    for text, ids in zip(texts, own.encode(texts), strict=True):
        ids = byte_bpe.id_array(ids)
        assert ids.tolist() == other.encode_ordinary(text), repr(text[:80])
        assert own.decode(ids).tobytes() == text.encode()


def test_query_against_the_other_library(spark, other):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.queries()["op13_byte_bpe"](spark, SF01).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = np.array(other.encode_ordinary(text or ""), "<u4")
        r = got[doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), brute.sha(ids.tobytes()), brute.sha(text or ""))


def test_random_texts(own, other):
    rnd = random.Random(7)
    texts = ["", " ", "it's they'll I'D 'll", "banana bananana", "a" * 5000, "-" * 777, "<|endoftext|>", "日本語 テキスト", "\U0001f600" * 40]
    pools = ["ab", "abc ", "ab\n \t", "'slrevmtd ", "0123456789 .", "aeiounst", "-=_*#", "éèüß   \u0085", "日本語中文 漢",
             "١²½Ⅷ", "\U0001f600\U0001f468‍"]
    for pool in pools:
        texts += ["".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 60))) for _ in range(150)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(0xD800), rnd.randrange(0xE000, 0x110000), rnd.randrange(128)]))
                      for _ in range(200)) for _ in range(100)]
    words = [w for t in texts for w in t.split()]
    texts += [" ".join(rnd.choice(words) for _ in range(4000)) for _ in range(5)]  # several windows
    agree(own, other, texts)


def test_windows_and_long_runs(own, other):
    for size in (byte_bpe.WINDOW - 1, byte_bpe.WINDOW, byte_bpe.WINDOW + 1, 3 * byte_bpe.WINDOW):
        for fill in ("a", " ", "a ", "'ll ", "\n"):
            texts = [(fill * size)[:size] + tail for tail in ("", "b", "'ll", "  x", "'l")]
            agree(own, other, [*texts, *(t + "\u65e5" for t in texts), *("\u65e5" + t for t in texts)])
    agree(own, other, ["word " * 600_000, "x" + " " * 300_000 + "y"])


def test_classes_of_characters_agree():
    """The splitter and the other library see the same letters, numbers and spaces."""
    from tokenizers import Regex, normalizers

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    single = {bytes([b]): b for b in range(256)}
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        one = bytes(tiktoken.Encoding("probe", pat_str=kind, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)).decode()
        assert set(every) - set(normalizers.Replace(Regex(kind), "").normalize_str(every)) == set(one)


def test_plain_characters_are_cut_alike(own):
    import regex

    plain = [chr(c) for c in range(0x2028) if not own.other.match(chr(c))]
    assert len(plain) == 0x250 + 0x18
    from tokenizers import Regex, normalizers

    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        found = set(plain) - set(normalizers.Replace(Regex(kind), "").normalize_str("".join(plain)))
        assert {c for c in plain if regex.match(kind, c)} == found
    rnd = random.Random(4)
    for _ in range(600):
        text = "".join(rnd.choice(rnd.choice([plain, " \n\t", "'slredvtm", "abc19", "\x1c\x85\xa0"])) for _ in range(80))
        assert list(own.pieces(text)) == list(own.split(text))


def test_ties_between_pairs_of_one_token(other):
    """The order of equal tokens made of different pairs, where pairs have ranks of their own in the library."""
    import base64
    import tempfile

    made = ["a", "b", "c", "ab", "ba", "aba", "abab", "bab", "cab", "abc", "abca", "ca"]
    ranks = {bytes([b]): b for b in range(256)} | {t.encode(): 256 + i for i, t in enumerate(made) if len(t) > 1}
    with tempfile.NamedTemporaryFile("wb", suffix=".tiktoken", delete=False, dir="/tmp") as f:
        f.write(b"\n".join(base64.b64encode(t) + b" " + str(r).encode() for t, r in ranks.items()))
    plain = tiktoken.Encoding("small", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(2)
    agree(byte_bpe.Codec(f.name, r"\S+|\s+"), plain, ["".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 30))) for _ in range(3000)])


def test_offsets_and_split_characters(spark, own):
    texts = ["the cat", "\U0001f600 é日本 x", "naïve 漢字𠜎", ""]
    reference = own.model
    for text in texts:
        (ids,) = own.encode([text])
        ids = byte_bpe.id_array(ids)
        start, end = own.offsets(ids)
        assert all(a < b for a, b in zip(start, end, strict=True)) and (not len(end) or end[-1] == len(text))
        for piece in own.pieces(text):  # the library's own offsets of a match
            found = reference.encode(piece, add_special_tokens=False)
            mine = own.offsets(np.array(found.ids, "<u4"))
            assert [tuple(x) for x in found.offsets] == list(zip(*(m.tolist() for m in mine), strict=True))
        assert "".join(own.decode_chunks([ids[k : k + 1] for k in range(len(ids))])) == text
    (ids,) = own.encode(["\U0001f600"])
    half = byte_bpe.id_array(ids)[:1]
    assert own.decode_chunks([half]).__next__() == "" and "".join(own.decode_chunks([half])) == "�"
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    rows = byte_bpe.decode(byte_bpe.encode(docs, **OWN, with_offsets=True), **OWN, text=True).collect()
    assert {r.doc_id: r.decoded for r in rows} == dict(enumerate(texts))
    assert all(len(r.starts) == len(r.ends) == len(r.ids) // 4 for r in rows)


def test_defined_cases(spark, own):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "x y", 0.5), (3, "x y", 0.5), (3, "x y", 0.5)],
                                 "doc_id long, text string, decoded double")
    rows = byte_bpe.encode(docs, **OWN).collect()
    assert sorted((str(r.doc_id), len(r.ids)) for r in rows) == [("1", 0), ("2", 0), ("3", 8), ("3", 8), ("None", 8)]
    assert byte_bpe.encode(docs.limit(0), **OWN).count() == 0
    ids = spark.createDataFrame([(1, None, 7), (2, bytearray(b""), 8)], "doc_id long, ids binary, decoded int")
    got = {r.doc_id: r.decoded for r in byte_bpe.decode(ids, **OWN).collect()}
    assert got == {1: None, 2: bytearray(b"")}
    with pytest.raises(ValueError):
        own.decode(np.array([60_000], "<u4"))
