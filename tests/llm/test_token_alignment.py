"""Alignment of two tokenizers against plain loops over the libraries' own tokens."""

import bisect
import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from eventlake.llm import token_alignment as T

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, block string, docs int"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(rows, libraries):
    a, b = libraries
    byte = T.byte_alphabet()
    docs = []
    for i, text in rows:
        raw = (" " + text).encode() if text else b""
        ta = [(k, bytes(byte[c] for c in a.id_to_token(k))) for k in a.encode(" " + text, add_special_tokens=False).ids] if text else []
        tb = [(k, bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode()) for k in (b.encode(text) if text else []) for p in [b.id_to_piece(k)]]
        if b"".join(x for _, x in ta) != raw or b"".join(x for _, x in tb) != raw:
            ta = tb = []
        spans = []
        for tokens in (ta, tb):
            at, out = 0, []
            for k, x in tokens:
                out.append((k, at, at + len(x)))
                at += len(x)
            spans.append(out)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups = [([], []) for _ in ends]
        for side, each in enumerate(spans):
            for k, _, e in each:
                groups[bisect.bisect_left(ends, e)][side].append(str(k))
        links, low = [], 0
        for k, s, e in spans[0]:
            while low < len(spans[1]) and spans[1][low][2] <= s:
                low += 1
            at = low
            while at < len(spans[1]) and spans[1][at][1] < e:
                links.append((k, spans[1][at][0]))
                at += 1
        said = ";".join("|".join(",".join(x) for x in g) for g in groups)
        docs.append((i, len(ta), len(tb), len(groups), links, hashlib.sha256(said.encode()).hexdigest() if ta else ""))
    count = collections.Counter(p for d in docs for p in set(d[4]))
    best = collections.defaultdict(int)
    for (k, _), n in count.items():
        best[k] = max(best[k], n)
    return [(i, na, nb, g, len(x), sum(count[p] == best[p[0]] for p in x), sum(count[p] for p in x), h) for i, na, nb, g, x, h in docs]


def check(spark, rows, libraries, parts=3):
    df = spark.createDataFrame([(i, t, "clash", 7) for i, t in rows], SCHEMA).repartition(parts)
    out = T.aligned(df, A, B)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    key = lambda r: tuple((x is None, x) for x in r)
    got, want = sorted((tuple(r) for r in out.collect()), key=key), sorted(plain(rows, libraries), key=key)
    assert got == want
    return got


def prose(rng, n):
    words = ["the", "Tokenizer", "donaudampfschiff", "über", "naïve", "été", "données", "3.14", "don't", "it's", "x_y", "日本語", "привет", "🙂", "á", "1234567", "--", "..."]
    return "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "", "\t", "  "]) for _ in range(n))


ODD = [None, "", " ", "  ", "\n\n", "a", "▁", "a▁b", "ﬁ", "Å", "Å", "<0x41>", "<s> </s> <unk>", "<|endoftext|> x", "\x00\x01", "​", "½ ™", "ｆｕｌｌ", "\r\n x", "é"]


def test_is_that_of_a_plain_loop(spark, monkeypatch, libraries):
    rng = random.Random(3)
    rows = [(k, prose(rng, rng.randrange(1, 60))) for k in range(150)] + [(200 + k, t) for k, t in enumerate(ODD)]
    rows += [(300 + k, "the same text, again") for k in range(80)] + [(5, "a second text of id 5"), (None, "no id"), (None, None)]
    got = check(spark, rows, libraries)
    assert sum(r[1] == 0 for r in got) >= 4
    monkeypatch.setattr(T, "BLOCK_DOCS", 16)
    monkeypatch.setattr(T, "PIECE_BYTES", 300)
    assert check(spark, rows, libraries, 2) == got


def test_long_texts(spark, libraries):
    rng = random.Random(8)
    check(spark, [(1, prose(rng, 20_000)), (2, "a" * 20_000), (3, " " * 5_000 + "x"), (4, "the " * 20_000), (5, "x")], libraries)


def test_empty_table(spark, libraries):
    assert check(spark, [], libraries) == []
    check(spark, [(1, None), (2, "")], libraries)


def test_fast_encoder_is_the_library_s(libraries):
    a = T.ByteLevel(open(A).read())
    assert a.fast is not None
    rng = random.Random(1)
    texts = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x3000), rng.randrange(0xE000, 0x20000)])) for _ in range(60)) for _ in range(400)]
    for t in [x.encode(errors="ignore").decode() for x in texts] + [" " * 300 + "a", "　　x", "' 's 'S"]:
        assert a.encode(t).tolist() == libraries[0].encode(t, add_special_tokens=False).ids
    a.fast = None
    assert a.encode("<|endoftext|> plain").tolist() == libraries[0].encode("<|endoftext|> plain", add_special_tokens=False).ids


def test_bitmaps_return_their_postings():
    rng = np.random.default_rng(0)
    for docs, pairs, share in ((1, 1, 1.0), (100, 40, 0.02), (100, 40, 0.9), (5000, 30, 0.1), (9, 0, 0.5)):
        pair, doc = np.nonzero(rng.random((pairs, docs)) < share)
        p, d = T.unpack(T.pack(pair, doc, pairs, docs), pairs, docs)
        assert sorted(zip(p.tolist(), d.tolist())) == list(zip(pair.tolist(), doc.tolist()))


def test_totals_are_exact():
    doc, count = np.array([0, 0, 1]), np.array([2**60 + 1, 2**55 + 3, 7])
    assert T._totals(doc, count, 3).tolist() == [2**60 + 2**55 + 4, 7, 0]
