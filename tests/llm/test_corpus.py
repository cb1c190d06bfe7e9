"""Corpus operators: brute force on small tables, and nulls, empty texts, repeats and clashing names."""

import base64
import hashlib
import html
import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("eventlake.llm.queries")
import public_tokenizers  # noqa: E402
import tiktoken  # noqa: E402

from eventlake.llm import bpe, chat, decontaminate, html_text, line_dedup, merkle, near_dedup, pii, sharding, toxicity  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, `row` string, `found` bigint, `spans` string, `bucket` int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "clash", 1, "x", 2) for i, t in rows], SCHEMA)


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(60):
        base = prose(rng, words, rng.randint(20, 120)).split()
        rows.append((len(rows), " ".join(base)))
        for _ in range(rng.choice([0, 0, 1, 3])):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    more = [None, "", "  \t\n ", "One two three", "one TWO three", "a" * 30_000, "only four words here", "word " * 20_000]
    rows += [(len(rows) + k, t) for k, t in enumerate(more)]
    return [*rows, (None, rows[0][1]), (5, rows[5][1])]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_near_duplicates_are_those_of_brute_force(spark, corpus):
    sets = {i: shingles(t) for i, t in corpus if i is not None}
    label = {i: i for i in sets}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    rows = near_dedup.near_duplicates(table(spark, corpus)).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), label[r.doc_id], r.doc_id == label[r.doc_id])


def test_pairs_inside_a_large_family_are_found(spark):
    """400 documents that resemble each other at 0.69, in pairs at 0.82: no pair is parted for good by the hub and chunk rules."""
    rng, n = random.Random(11), 400
    base = [f"w{k}" for k in range(n)]

    def changed(words, k):
        words = list(words)
        for at in rng.sample(range(n), k):
            words[at] = f"m{rng.randrange(10**9)}"
        return words

    texts = []
    for _ in range(200):
        root = changed(base, 4)
        texts += [" ".join(changed(root, 4)), " ".join(changed(root, 4))]
    sets = [shingles(t) for t in texts]
    like = lambda a, b: 100 * len(a & b) >= 75 * len(a | b)
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(table(spark, list(enumerate(texts)))).collect()}
    linked = [k for k in range(0, 400, 2) if like(sets[k], sets[k + 1])]
    assert len(linked) > 190 and sum(found[k] == found[k + 1] for k in linked) >= 0.97 * len(linked)
    label = {k: k for k in found}
    links = [(a, b) for a, b in itertools.combinations(found, 2) if like(sets[a], sets[b])]
    for _ in range(40):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert all(label[k] == label[found[k]] for k in found)  # no wrong link


def test_near_duplicates_of_repeated_ids(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(500)]
    a, b, c, x = (prose(rng, words, 60) for _ in range(4))
    near = lambda t: t + " end"
    rows = [(4, a), (5, a), (5, b), (6, b), (7, near(a)), (8, near(b)), (9, c), (9, c), (10, ""), (5, ""), (11, None), (None, a), (12, x)]
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(table(spark, rows)).collect()}
    component = {4: 4, 5: 4, 6: 4, 7: 4, 8: 4, 9: 9, 10: 10, 11: 11, 12: 12, None: None}
    assert got == {(i, len(shingles(t)), component[i], i is None or component[i] == i) for i, t in rows}


def test_near_duplicates_of_a_large_group(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(5000)]
    base = prose(rng, words, 200).split()
    rows = []
    for k in range(400):
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(200)] = rng.choice(words)
        rows.append((k, " ".join(copy)))
    rows += [(1000 + k, prose(rng, words, 100)) for k in range(50)]
    got = near_dedup.near_duplicates(table(spark, rows))
    assert {r.component_id for r in got.where("doc_id < 1000").collect()} == {0}
    assert got.where("doc_id >= 1000 and kept").count() == 50


def test_empty_tables(spark):
    none = table(spark, [])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert near_dedup.near_duplicates(none).count() == 0
    assert line_dedup.line_dedup(none).count() == 0
    assert decontaminate.contamination(none, items).count() == 0
    assert toxicity.toxicity(none, labels).count() == 0
    assert sharding.sharded(none).count() == 0
    assert merkle.with_next(none).count() == 0
    assert pii.personal_spans(none).count() == 0
    assert bpe.encoded(none, RANKS).count() == 0


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_bpe_is_the_library_s(spark):
    raw = open(RANKS, "rb").read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    pool = [" ", "  ", "\n", "\t", "'s", "'", "'re", "'ve", "'ll", "'d", "'m", "'t", "a", "Hello", "wörld", "é", "1", "23", "²", "Ⅷ", "!", "...", "—", " ", " ", "中文", "😀", "'S", "\r\n", "\x1c", "_", "the", "́", "\x00"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(2000)] + [None, "", "a" * 20_000, " " * 3000 + "x"]
    vocabulary = bpe.Vocabulary(raw)
    ids, at = vocabulary.encode(pa.array(texts, pa.string()))
    for k, t in enumerate(texts):
        own = ids[at[k] : at[k + 1]]
        assert own.tolist() == library.encode_ordinary(t or "")
        assert vocabulary.decode(own.tobytes()) == (t or "").encode()
    df = bpe.decoded(bpe.encoded(table(spark, [(k, t) for k, t in enumerate(texts[:50] + texts[-4:])]), RANKS), RANKS)
    assert df.where(F.col("decoded") != F.encode(F.coalesce(F.col("row.text"), F.lit("")), "UTF-8")).count() == 0


def test_bpe_compares_bytes_where_hashes_meet(monkeypatch):
    vocabulary = bpe.Vocabulary(open(RANKS, "rb").read())
    texts = pa.array(["hello world, the cats and dogs", "zxqv hello", None, "the the"], pa.string())
    ids, at = vocabulary.encode(texts)
    own = bpe.hashes
    monkeypatch.setattr(bpe, "hashes", lambda body, start: own(body, start) % np.uint64(3))
    again, to = vocabulary.encode(texts)
    assert ids.tolist() == again.tolist() and at.tolist() == to.tolist()
    monkeypatch.setattr(bpe, "hashes", lambda body, start: np.full(len(start), own(np.frombuffer(b" the", np.uint8), np.array([0]))[0]))
    again, to = vocabulary.encode(texts)
    assert ids.tolist() == again.tolist() and at.tolist() == to.tolist()


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64))
    h = bpe.PerfectHash(keys)
    assert sorted(h.find(keys)) == list(range(len(keys)))
    assert (h.find(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == -1).all()


PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = "".join(c for c in m[0] if c.isdigit())
            luhn = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0
            if [True, all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True, 13 <= len(digits) <= 19 and luhn, 9 <= len(digits) <= 15][kind]:
                out.append((kind, *m.span()))
    return sorted(out)


def test_pii_base_spans():
    rng = random.Random(2)
    parts = ["a", "@", ".", "1", "23", "4111111111111111", " ", "-", "+", "(", ")", "b.c", "_", "é", "\n", "0", "5"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert sorted(pii.identifiers(text)) == plain(text)


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("mail bob (at) mail dot com now", "email", "bob (at) mail dot com"),
        ("call plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
        ("at one two seven dot zero dot zero dot one", "ip", "one two seven dot zero dot zero dot one"),
        ("ｂｏｂ＠ｅｘ．com", "email", "ｂｏｂ＠ｅｘ．com"),
        ("4111​1111-11111111", "card", "4111​1111-11111111"),
    ],
)
def test_pii_disguises(text, kind, found):
    base, added = pii.personal_data(text)
    assert (base, [(pii.KINDS[k], text[a:b]) for k, a, b in added]) == ([], [(kind, found)])


def test_pii_leaves_prose_alone(spark):
    assert pii.personal_data("we met at dawn, the dot was red; un un deux, point") == ([], [])
    rows = pii.personal_spans(table(spark, [(1, None), (2, ""), (3, "x a@b.c"), (3, "x a@b.c")])).collect()
    assert sorted(len(r.spans) for r in rows) == [0, 0, 1, 1]


def test_pii_gate_lets_every_disguise_through(spark):
    rng = random.Random(23)
    parts = ["john", "at", "AT", "arroba", "dot", "punto", "example", "com", "one", "zwei", "nine", "plus", "b-c"] * 2 + ["@", ".", "(", ")", "[at]", "ſ", "ʰ", "ĳ", "ö", "ß", "é", "е", "１", "\u00ad", "4", "\n", ",", "-", "\u00a0"]
    texts = ["mail john at example.com now", "boſs@maiſ.com", "jo\u02b0n@e\u02b0.com", "we met at dawn. Later"]
    texts += ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "  "]) for _ in range(rng.randint(1, 9))) for _ in range(20_000)]
    spans = {r.doc_id: [(s["kind"], s["start"], s["end"], s["disguised"]) for s in r.spans] for r in pii.personal_spans(table(spark, list(enumerate(texts)))).selectExpr("row.doc_id", "spans").collect()}
    assert spans[0] == [("email", 5, 24, True)] and spans[1][-1] == ("email", 0, 13, True) and spans[2][-1][3]
    for k, text in enumerate(texts):
        base, added = pii.personal_data(text)
        assert spans[k] == [(pii.KINDS[s[0]], *s[1:], d) for d, found in ((False, base), (True, added)) for s in found], text


def test_pii_of_long_texts_is_linear(spark):
    odd = "a (at) b [dot] com " + " " * 200_000 + "x" + "\t(" * 50_000 + " one  two" * 20_000 + " @ " * 20_000 + "[ " * 50_000
    base, added = pii.personal_data(odd)
    assert base == [] and added[0] == (0, 0, 18)
    assert [len(r.spans) for r in pii.personal_spans(table(spark, [(1, odd)])).collect()] == [len(added)]


def test_queries_return_what_their_contracts_say(spark):
    """The registered queries over the smallest tables, against plain loops."""
    import zlib

    from eventlake.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    kinds = ("email", "ip", "card", "phone")
    got = queries.op3_pii(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        base = plain(docs[r.doc_id])
        assert r.base_sha256 == sha(",".join(f"{kinds[k]}:{a}:{b}" for k, a, b in base))
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert {(kinds[k], str(a), str(b)) for k, a, b in base} <= {tuple(s) for s in spans}
        assert spans == sorted(spans, key=lambda s: (kinds.index(s[0]), int(s[1])))
        assert [r[f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in spans) for k in kinds]
    got = queries.op4_sharding(spark, sf).collect()
    assert {(r.doc_id, r.size, r.text_crc32, r.law) for r in got} == {(i, len(t.encode()) + 1, zlib.crc32(t.encode()), "key") for i, t in docs.items()}
    assert {r.doc_id: (r.shard, r.grown_shard) for r in got} == dict(zip(docs, zip(*(sharding.jump(np.array(list(docs)), n).tolist() for n in (8, 9)))))
    turns = sorted((r.conv_id, r.turn, r.role or "", r.text or "") for r in spark.read.parquet(f"{sf}/conversations.parquet").collect())
    turns += [(-7, k, role, r"\### Assistant: </turn> ok") for k, role in enumerate(("user", "assistant"))]
    got = {r.conv_id: r for r in queries.op10_chat_format(spark, sf).collect()}
    assert set(got) == {t[0] for t in turns}
    for c, r in got.items():
        own = [t for t in turns if t[0] == c]
        loss = "".join(t[3] for t in own if t[2] == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), sha("".join(f"{t[2]}\n{t[3]}\n" for t in own)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss)) and r.formatted_chars > sum(len(t[3]) for t in own)
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.op6_html_text(spark, sf).collect():
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:h1|p|br)>", body)]
        assert (r.text, r.n_chars) == (" ".join(x for x in blocks if x), len(r.text))
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op7_toxicity(spark, sf).collect()
    assert {r.doc_id for r in got} == set(docs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert np.mean([a == b for a, b in held]) > 0.9


def test_shards(spark, corpus):
    rows = sharding.sharded(table(spark, corpus)).collect()
    assert len(rows) == len(corpus)
    for shard in range(8):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    keys = np.arange(50_000)
    wide = [(1 << 60) + k for k in range(50)]
    shard_of = lambda ids: {r.doc_id: (r.shard, r.grown_shard) for r in sharding.sharded(table(spark, [(i, "x") for i in ids])).collect()}
    alone, beside = shard_of(wide), shard_of([None, *wide])
    assert {i: beside[i] for i in wide} == alone and alone[wide[0]][0] == sharding.jump(np.array(wide[:1]), 8)[0]
    counts = np.bincount(sharding.jump(keys, 8))
    assert counts.min() > 5900 and (sharding.jump(keys, 9) != sharding.jump(keys, 8)).mean() == pytest.approx(1 / 9, abs=0.01)


def test_merkle(spark):
    rows = [(0, "One. Two.\nThree."), (1, "One. Two.\nFour."), (2, ""), (3, None), (4, "One. Two.\nThree."), (None, "x")]
    out = {(r.doc_id, r.text): r for r in merkle.with_next(table(spark, rows)).collect()}
    assert out[0, rows[0][1]].fingerprint == out[4, rows[0][1]].fingerprint != out[1, rows[1][1]].fingerprint
    assert out[None, "x"].next_text == rows[0][1] and out[4, rows[0][1]].next_text == "x"
    pair = spark.createDataFrame([(out[0, rows[0][1]].fingerprint, out[1, rows[1][1]].fingerprint)], "a string, b string")
    got = pair.select(merkle.likeness(F.col("a"), F.col("b")), merkle.edited_range(F.col("a"), F.col("b")), merkle.likeness(F.col("a"), F.col("a")), merkle.edited_range(F.col("a"), F.col("a"))).first()
    assert got[0] == pytest.approx(2 / 3) and tuple(got[1]) == (1, 2) and got[2] == 1.0 and got[3] is None


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def tree(text):
    """Sections of paragraphs of (hash, leaf hashes), by plain loops."""
    out = [[]]
    for p in re.split(r"(?<=\n)", text) if text else []:
        at = [0]
        for k in range(1, len(p) + 1):
            if re.fullmatch(r"[.!?] ", p[k - 2 : k]) or k - at[-1] == 64:
                at.append(k)
        cuts = [p[a:b] for a, b in zip(at, [*at[1:], len(p)]) if a < b]
        own = [sha(x) for x in cuts]
        out[-1].append((sha("".join(own)), own))
        if out[-1][-1][0][0] < "4":
            out.append([])
    return out


def printed(text):
    t = tree(text)
    whole = [sha("".join(h + "," for h, _ in s)) for s in t]
    body = ";".join(w[:8] + "=" + "".join(h[:8] + "-" + ".".join(x[:6] for x in own) + "," for h, own in s) for w, s in zip(whole, t))
    return sha("".join(whole)) + ":" + body


def alike(a, b):
    """Likeness of two texts by their trees."""
    if a == b:
        return 1.0
    x, y = tree(a), tree(b)
    keys = [{repr(s) for s in t} for t in (x, y)]
    same = [s for k, s in {repr(s): s for s in x}.items() if k in keys[1]]
    px, py = ({h: own for s in t if repr(s) not in keys[1 - k] for h, own in s} for k, t in enumerate((x, y)))
    n = sum(len(own) for s in same for _, own in s) + sum(len(own) for h, own in px.items() if h in py)
    lx, ly = ({v for h, own in p.items() if h not in q for v in own} for p, q in ((px, py), (py, px)))
    total = 2 * n + len(lx) + len(ly)
    return 2 * (n + len(lx & ly)) / total if total else 0.0


def test_merkle_is_that_of_brute_force(spark, tmp_path):
    from eventlake.llm import queries

    rng = random.Random(31)
    words = ["one", "two.", "three!", "é", "😀", "日本語の行です", "x" * 150]
    rows = [(k * 3, "".join(rng.choice(words) + rng.choice([" ", "\n", "", ". "]) for _ in range(rng.randint(0, 40)))) for k in range(60)]
    rows += [(200, None), (201, ""), (-(1 << 62), "a" * 5000), (1 << 62, "no dot here " * 50), (203, rows[0][1])]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op5_merkle(spark, str(tmp_path)).collect()}
    rows = sorted((i, t or "") for i, t in rows)
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), sha(edited), printed(t), printed(edited))
        assert r.near_edited == pytest.approx(alike(t, edited)) and r.near_next == pytest.approx(alike(t, after))
        x, y = ([h for s in tree(v) for h, _ in s] for v in (t, edited))
        if t != edited:
            front = next((j for j in range(max(len(x), len(y))) if x[j : j + 1] != y[j : j + 1]), 0)
            back = 0
            while back < min(len(x), len(y)) - front and x[-1 - back] == y[-1 - back]:
                back += 1
            assert tuple(r.edited_paragraphs) == (front, len(y) - back)
    assert got[1 << 62].near_edited > 0.4


def test_merkle_buckets_are_small(spark):
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    odd = spark.createDataFrame([(10**12, "y"), ((1 << 63) - 1, "z"), (-(1 << 63), "w")], "doc_id bigint, text string")
    same = spark.range(5_000).select(F.lit(70_000).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    dealt, n = merkle._bucketed(ids.union(odd).union(same))
    assert n == 25_003 and dealt.groupBy("bucket").count().agg(F.max("count")).first()[0] <= 6_000
    order = [(r.doc_id, r.bucket) for r in dealt.collect()]
    assert [b for _, b in sorted(order)] == sorted(b for _, b in order)
    assert dealt.where("doc_id < 20000").groupBy("bucket").count().agg(F.max("count")).first()[0] < 1_000


PAGE = "<html><head><title>T</title></head><body><nav><a>home</a></nav><div class='cookie'>We use cookies</div><{0}><h1>Big  title</h1><p>First &amp; long\nparagraph of words<br>with a break</p><div class=ad>Buy now</div><p>Second <b>bold</b> part<script>x('</p>')</script></p></{0}><div id=comments><p>nice one</p></div><footer>foot</footer></body></html>"


def test_html(spark):
    want = "Big title First & long paragraph of words with a break Second bold part"
    pages = spark.createDataFrame([(1, PAGE.format("article"), "c"), (2, PAGE.format("div"), "c"), (3, None, "c"), (4, "", "c"), (5, "<p", "c")], "page_id bigint, html string, `row` string")
    got = {r[0]: r[1] for r in html_text.extracted(pages).select("row.page_id", "text").collect()}
    assert got == {1: want, 2: want, 3: "", 4: "", 5: ""}


BODY = "<h1>Short title</h1><p>" + "word " * 60 + "</p><p>It is.</p><p>more " + "text " * 40 + "</p>"
PROSE = " ".join(re.sub(r"<[^>]*>", " ", BODY).split())


@pytest.mark.parametrize(
    "page",
    [
        f'<body class="has-sidebar">{BODY}</body>',
        f'<article class="post no-comments">{BODY}</article>',
        f"<form action=x>{BODY}</form>",
        f"<nav><div>{BODY}</div>",
        f"<p>{BODY[4:]}".replace("Short", "<h1>Short", 1),
        f'<div>{BODY}<div class="ad-box">Buy now</div></div><div id="comments"><p>{"nice " * 30}</p></div>',
        f"<aside>{'side ' * 50}</aside>{BODY}<div role=contentinfo>{'foot ' * 40}</div>",
    ],
)
def test_html_frames_and_hints(page):
    assert html_text.main_text(page, {}) == PROSE


def test_html_run_follows_what_labelled_pages_teach(spark):
    """Kinds that nothing hints at: only the learned weights keep them out of the best run."""
    page = "<div class=x9>" + "<i>link text here</i>" * 12 + "</div><{0}>" + BODY + "</{0}><section class=q7>" + "tail " * 30 + "</section>"
    learned: dict = {}
    for _ in range(50):
        for kind, seen in html_text.tag_counts(page.format("article")).items():
            of = learned.setdefault(kind, [0, 0, 0])
            of[0], of[1], of[2] = of[0] + seen[0], of[1] + seen[1], max(of[2], seen[2])
    assert html_text.main_text(page.format("section"), learned) == PROSE
    assert html_text.main_text(page.format("section"), {}) != PROSE
    pages = spark.createDataFrame([(k, page.format("article" if k < 50 else "section")) for k in range(60)], "page_id bigint, html string")
    assert {r.text for r in html_text.extracted(pages).collect()} == {PROSE}
    assert html_text.extracted(pages.limit(0)).count() == 0


def test_html_run_alone_leaves_thin_text_out(monkeypatch):
    """Elements of no known kind: single words between tags cost more than they score."""
    thin = "<div><span>go</span></div>" * 15
    assert html_text.main_text(thin + BODY + thin, {}) == PROSE
    monkeypatch.setattr(html_text, "UNSEEN_PENALTY", 0.0)
    assert html_text.main_text(thin + BODY + thin, {}) != PROSE


WORDS = "These are words of an article that nobody may lose, and there are more than enough of them here."


@pytest.mark.parametrize(
    "page,text",
    [
        (f"<html><head><title>No</title><meta charset=utf-8><body><article><p>{WORDS}</p></article></body>", WORDS),
        (f"<article><p>{WORDS}</p><svg width=1/><p>{WORDS}</p><iframe src='x'/><p>{WORDS}</p></article>", " ".join([WORDS] * 3)),
        (f"<article><p>{WORDS}</p><svg><path d=1><p>{WORDS}</p></article>", f"{WORDS} {WORDS}"),
        (f"<article><p>{WORDS}</p><svg><title>No</title></svg><p>{WORDS}</p><object data=x>No</object></article>", f"{WORDS} {WORDS}"),
        (f"<article><p title=it's>{WORDS}</p><p title=\"a>b\" alt='>'>{WORDS}</p><p a\"b>{WORDS}</p></article>", " ".join([WORDS] * 3)),
        (f"<article><p>{WORDS}</p></article><script>if (a < b) No", WORDS),
        (f"<article><p>{WORDS}</p><SCRIPT>No</SCRIPT ><p>{WORDS}</p></article>", f"{WORDS} {WORDS}"),
        (f"<article><p>{WORDS} 1 < 2 and x<3</p></article>", f"{WORDS} 1 < 2 and x<3"),
    ],
)
def test_html_of_unclosed_and_odd_tags(page, text):
    assert html_text.main_text(page, {}) == text


def test_html_many_unclosed_elements_are_linear():
    page = f"<article><p>{WORDS}</p>" + "<svg a='b'><iframe><head>" * 60_000 + "</article>"
    began = time.time()
    assert html_text.main_text(page, {}) == WORDS
    assert time.time() - began < 20


def test_html_long_page_is_linear():
    page = "<div>" + "<p>word <b>bold</b></p>" * 50_000 + "</div>"
    assert len(html_text.main_text(page, {}).split()) == 100_000


def test_toxicity(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(600):
        toxic = k % 4 == 0
        text = prose(rng, words, 40) + (" vileword women" if toxic else " women" if k % 8 == 1 else "")
        rows.append((k, text))
        labels.append((k, 1, int(toxic)))
    labels += [(None, 1, 1), (3, 1, None)]
    got = toxicity.toxicity(table(spark, [*rows, (None, None), (9999, "")]), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    held = got.where("held_out and doc_id < 600").collect()
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 4 == 0) for r in held]) > 0.97
    neutral = [r for r in held if r.doc_id % 8 == 1]  # they mention a group, as the toxic ones do
    assert neutral and not any(r.predicted for r in neutral)
    assert got.count() == 602 and got.where("score is null or score < 0 or score > 1").count() == 0


def test_counterfactual_penalty_draws_mentions_together(monkeypatch):
    rows = []
    for k in range(400):
        toxic = k % 2
        text = "vile women here" if toxic and k % 3 else "vile stuff" if toxic else "men walk" if k % 3 else "plain words"
        rows.append((text, toxicity.counterfactual(text), toxic))
    feats = lambda t: np.unique(toxicity.row_features(pa.array([t]))[1]).astype("<u4").tobytes()
    packed = [(feats(t), feats(o) if o else None, y) for t, o, y in rows]

    def gap(penalty):
        monkeypatch.setattr(toxicity, "COUNTERFACTUAL", penalty)
        model = toxicity.fit(packed)
        score = lambda t: model.scores(pa.array([t]), model.dense())[0]
        return abs(score("women here") - score("men here"))

    assert gap(5.0) < 0.6 * gap(0.0)


def test_lines_are_those_of_brute_force(spark):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(60)]
    pool = [prose(rng, words, rng.randint(1, 25)) for _ in range(60)]
    rows = []
    for k in range(80):
        lines = []
        for _ in range(rng.randint(1, 6)):
            line = rng.choice(pool).split()
            for _ in range(rng.randint(0, 2)):
                line[rng.randrange(len(line))] = rng.choice(words)
            lines.append(" ".join(line))
        rows.append((k, "\n".join(lines)))
    seen, gone = [], set()
    for k, t in rows:
        for pos, line in enumerate(t.split("\n")):
            own = set(line.lower().split())
            if own:
                if any(4 * len(own & o) >= 3 * len(own | o) for o in seen):
                    gone.add((k, pos))
                seen.append(own)
    out = line_dedup.line_dedup(table(spark, [*rows, (100, None), (101, ""), (None, rows[0][1])])).selectExpr("row.doc_id", "n_lines", "removed", "text").collect()
    got = {(r.doc_id, p) for r in out for p in r.removed if r.doc_id is not None}
    assert got == gone
    assert {r.doc_id: r.text for r in out}[100] is None
    for r in out:
        if r.doc_id is not None and r.doc_id < 100:
            assert r.text == "\n".join(x for p, x in enumerate(rows[r.doc_id][1].split("\n")) if (r.doc_id, p) not in gone)


def duplicate_lines(rows):
    """(row number, line number) of each line that an earlier one matches, by all pairs."""
    seen, gone = [], set()
    for k, text in enumerate(rows):
        for pos, line in enumerate((text or "").split("\n")):
            own = {w for w in re.split(r"[ \t\x0b\f\r]+", line.lower()) if w}
            if own:
                if any(4 * len(own & o) >= 3 * len(own | o) for o in seen):
                    gone.add((k, pos))
                seen.append(own)
    return gone


def test_short_lines_are_those_of_brute_force(spark):
    rng = random.Random(12)
    words = ["a", "b", "c", "d", "e", "F", "g\th", "日本語の行です"]
    rows = ["\n".join(" ".join(rng.sample(words, rng.randint(0, 4))) for _ in range(2)) for _ in range(60)]
    rows += ["Menu\none two three", "menu\nfour one two three", "col1\tcol2\n\n   \nMenu", "col2  col1\r\n\n   \nshare  this", "This share share\nsolo"]
    gone = duplicate_lines(rows)
    assert {(61, 0), (61, 1), (62, 3), (63, 0), (64, 0)} <= gone and not {(62, 0), (62, 1), (62, 2), (63, 1), (64, 1)} & gone
    out = line_dedup.line_dedup(table(spark, list(enumerate(rows)))).selectExpr("row.doc_id", "removed").collect()
    assert {(r.doc_id, p) for r in out for p in r.removed} == gone


@pytest.mark.parametrize("limit", [500_000, 0])
def test_long_hot_and_repeated_lines(spark, monkeypatch, limit):
    """One text of thousands of lines, a large group of near copies, very long lines, repeated rows and ids."""
    monkeypatch.setattr(line_dedup, "BROADCAST_DOCS", limit)
    rng = random.Random(14)
    words = [f"w{k}" for k in range(3000)]
    base = prose(rng, words, 30).split()
    near = []
    for _ in range(300):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(30)] = rng.choice(words)
        near.append(" ".join(copy))
    giant = " ".join(words)
    rows = ["\n".join(near[:150]), *near[150:], giant, giant + " more", None, "", "\n\n", "\n".join(["same line"] * 3000)]
    gone = duplicate_lines(rows)
    assert (152, 0) in gone and len([g for g in gone if g[0] == len(rows) - 1]) == 2999
    got = line_dedup.line_dedup(table(spark, list(enumerate(rows)))).selectExpr("row.doc_id", "removed", "text").collect()
    assert {(r.doc_id, p) for r in got for p in r.removed} == gone
    assert {r.doc_id: r.text for r in got}[len(rows) - 1] == "same line"
    twice = line_dedup.line_dedup(table(spark, [(1, "a b c d\nx"), (1, "a b c d\nx"), (1, "y z"), (2, "y z\na b c d e")])).selectExpr("row.doc_id", "row.text AS t", "removed").collect()
    assert sorted((r.doc_id, r.t, list(r.removed)) for r in twice) == [(1, "a b c d\nx", []), (1, "a b c d\nx", []), (1, "y z", []), (2, "y z\na b c d e", [0, 1])]


def test_only_lines_that_meet_an_earlier_one_are_looked_up(spark):
    """Lines without a likely partner used to be kept in the first pass, with themselves, and written twice more."""
    alone = [" ".join(f"w{k}x{i}" for i in range(12)) + " of the same" for k in range(40)]
    near = [" ".join(f"n{i}" for i in range(20)) + f" own{k}" for k in range(3)]
    lines = line_dedup.ranked_lines(table(spark, list(enumerate([*alone, *near]))).select("doc_id", F.lit(0).cast("long").alias("h"), "text"))
    met = line_dedup._met_heads(lines).select("e.doc_id", F.col("l.doc_id").alias("later")).collect()
    assert met and {(r.doc_id, r.later) for r in met} <= {(40, 41), (40, 42), (41, 42)}


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


@pytest.mark.parametrize("block", [8 << 20, 200])
def test_contamination_is_that_of_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(13)
    words = [f"w{k}" for k in range(50)] + ["É", "ß"]
    items = [(k, prose(rng, words, rng.choice([1, 3, 12, 13, 14, 30]))) for k in range(20)] + [(20, None), (21, "..."), (3, "w1 w2 w3 w4"), (None, "w5 w6 w7")]
    rows = []
    for k in range(60):
        text = prose(rng, words, rng.randint(0, 60))
        if k % 3 == 0:
            text += " " + (rng.choice(items)[1] or "") + ", " + prose(rng, words, 5)
        rows.append((k, text))
    rows += [(60, None), (61, ""), (0, rows[0][1])]
    windows = {}
    for i, t in items:
        w = alnum(t)
        size = min(13, len(w))
        for a in range(len(w) - size + 1) if w and i is not None else []:
            windows.setdefault(tuple(w[a : a + size]), set()).add(str(i))
    got = decontaminate.contamination(table(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        w = alnum(text[r.doc_id])
        hit, found = [False] * len(w), set()
        for size in {len(k) for k in windows}:
            for a in range(len(w) - size + 1):
                ids = windows.get(tuple(w[a : a + size]))
                if ids:
                    found |= ids
                    hit[a : a + size] = [True] * size
        n = sum(hit)
        assert (r.n_words, r.n_hit, r.item_ids, r.contaminated) == (len(w), n, sorted(found), n > 0 and 20 * n >= len(w))
        assert sum(s["n_words"] for s in r.spans) == n
        best = {}
        for i, t in items:
            x = alnum(t)
            size = min(13, len(x))
            for q in range(len(x) if i is not None else 0):
                for a in range(len(w)):
                    k = 0
                    while q + k < len(x) and a + k < len(w) and x[q + k] == w[a + k]:
                        k += 1
                    if k >= size:
                        best[str(i)] = max(best.get(str(i), 0), k)
        longest = {}
        for m in r.matches:
            longest[m["item_id"]] = max(longest.get(m["item_id"], 0), m["n_words"])
            assert any(w[m["start"] : m["start"] + m["n_words"]] == alnum(t)[m["item_start"] : m["item_start"] + m["n_words"]] for i, t in items if str(i) == m["item_id"])
        assert longest == best


@pytest.mark.parametrize("budget, history", [(1024, 256), (60, 20), (5, 0)])
def test_chat_reads_back(spark, budget, history):
    rng = random.Random(17)
    bits = ["hello", "### x: ", "</turn>", " </turn>\n### user: ", "\\", "%3C", "%", "é", "", "a" * 100, "\n"]
    rows = []
    for c in range(40):
        for t in range(rng.randint(1, 8)):
            role = "system" if t == 0 and c % 3 == 0 else rng.choice(["user", "assistant", "a:b", None])
            rows.append((c, t, role, rng.choice([None, "".join(rng.choice(bits) for _ in range(5))])))
    rows += [(None, 0, "user", "x"), (None, None, "user", "y"), (3, 0, "user", "twice"), (3, 0, "user", "twice"), (50, 0, "system", "alone")]
    rows += [(60, 5000 * t, "assistant", f"far {t}") for t in range(9)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, key string, idx int")
    windows = chat.chat_windows(df, budget, history)
    back = {r.conv_id: r for r in chat.read_back(windows).collect()}
    formed = {}
    for r in windows.collect():
        formed.setdefault(r.conv_id, []).append((r.window, r.n_repeated, r.formatted))
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    written = lambda t: f"\n### {t[0]}: {t[1]} </turn>"
    esc = lambda x: x.replace("%", "%25").replace("#", "%23").replace("<", "%3C")
    for c in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=order)]
        assert (back[c].turns, back[c].n_turns) == ("".join(f"{r}\n{x}\n" for r, x in turns), len(turns))
        assert back[c].loss == "".join(x for r, x in turns if r == "assistant")
        system = turns[0] if turns[0][0] == "system" and len(turns) > 1 else None
        shown = [(esc(r).replace(":", "%3A"), esc(x)) for r, x in turns]
        for k, (at, repeated, text) in enumerate(sorted(formed[c])):
            assert k == 0 or at > sorted(formed[c])[k - 1][0]
            if k and system:
                assert repeated >= 1 and text.startswith(written(shown[0]))
            past = repeated - (1 if k and system else 0)
            lead = [shown[0]] if system else []
            assert text.startswith("".join(map(written, (lead if k else []) + shown[at - past : at])) if k else "".join(map(written, lead)))
            assert sum(-(-len(f"\n### :  </turn>{r}{x}".encode()) // 4) for r, x in turns[at - past : at]) <= history if k else repeated == 0


def test_chat_windows_keep_the_budget(spark):
    rows = [(1, t, "system" if t == 0 else "assistant" if t % 2 else "user", "x" * (400 if t == 0 else 40 + 997 * t % 900)) for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("own", F.length("text"))
    for tokens, of in ((None, lambda text: -(-len(text) // 4)), ("own", None)):
        got = chat.chat_windows(df, 1024 if tokens is None else 4096, 256, tokens=tokens).collect()
        if of:
            assert max(of(r.formatted) for r in got) <= 1024
        else:
            assert max(r.formatted.count("x") for r in got) <= 4096
        assert len(got) < 200 and sum(r.formatted.count("</turn>") - r.n_repeated for r in got) == 300


@pytest.mark.parametrize("turns, size", [(4_000, 1000), (40_000, 100)])
def test_chat_of_one_long_conversation(spark, turns, size):
    said = F.concat(F.col("id").cast("string"), F.lit(" "), F.repeat(F.lit("a"), size))
    df = spark.range(turns).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    back = chat.read_back(chat.chat_windows(df)).collect()
    whole = "".join(f"{'assistant' if t % 2 else 'user'}\n{t} {'a' * size}\n" for t in range(turns))
    assert len(back) == 1 and back[0].n_turns == turns and back[0].turns == whole
    assert chat.chat_windows(df.limit(0)).count() == 0


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(19)
    words = [f"w{k}" for k in range(3000)]
    clean = [(k, "\n".join(prose(rng, words, 12) for _ in range(5))) for k in range(60)]
    item = prose(rng, words, 30)
    toxic = [(100 + k, prose(rng, words, 30) + " vileword vileword") for k in range(60)]
    copies = [(200 + k, clean[k][1]) for k in range(10)]
    dirty = [(300, item + "\n" + prose(rng, words, 10))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in [*clean, *toxic, *copies, *dirty]], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(100 <= i < 200)) for i, _ in [*clean, *toxic]], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in out.collect()) == [i for i, _ in clean]
    assert out.where("not round_trip").count() == 0
    assert hashlib.sha256(out.where("doc_id = 0").first().text.encode()).hexdigest() == hashlib.sha256(clean[0][1].encode()).hexdigest()


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls in every column, empty texts, repeated rows and ids, clashing column names, and empty tables."""
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(23)
    words = [f"w{k}" for k in range(3000)]
    clean = [(k, prose(rng, words, 30)) for k in range(20)]
    odd = [(100, None), (101, ""), (102, "  \n\t"), (None, None), (None, prose(rng, words, 30)), (103, "x" * 50_000), clean[3], (104, prose(rng, words, 30)), (104, prose(rng, words, 30))]
    docs = table(spark, clean + odd)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(0, 1, 0), (None, 1, 1), (1, None, None), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(None, "a b"), (1, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = pipeline.run(spark, str(tmp_path))
    assert out.columns == [*docs.columns, "n_tokens", "token_ids", "round_trip"]
    rows = out.collect()
    assert {(r.doc_id, r.text) for r in rows} == set(clean + odd) and all(r.round_trip or r.text is None for r in rows)
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", spark.createDataFrame([], "item_id bigint, text string"))):
        df.limit(0).write.parquet(f"{tmp_path}/empty/{name}.parquet")
    assert pipeline.run(spark, f"{tmp_path}/empty").count() == 0


def test_copies_of_copies_in_large_families_are_linked(spark):
    """A copy of a copy may be like its source only, which is much like the family's hub and may not leave the recursion for that."""
    rng, docs = random.Random(1), []
    word = lambda: "w%d" % rng.randrange(10**6)
    for family, (n, length, edits) in enumerate([(800, 300, 6), (800, 300, 10), (1500, 300, 8), (400, 300, 10), (600, 200, 5)]):
        members = [[word() for _ in range(length)]]
        while len(members) < n:
            c = list(members[max(0, len(members) - 1 - rng.randrange(len(members)))] if rng.random() < 0.5 else members[0])
            for _ in range(rng.randrange(1, edits + 1)):
                c[rng.randrange(length)] = word()
            members.append(c)
        docs += [(family, m) for m in members]
    rng.shuffle(docs)
    sets = [frozenset(tuple(m[k : k + 5]) for k in range(len(m) - 4)) for _, m in docs]
    top = list(range(len(docs)))

    def find(k):
        while top[k] != k:
            top[k] = top[top[k]]
            k = top[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            if docs[a][0] == docs[b][0] and find(a) != find(b):
                common = len(sets[a] & sets[b])
                if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                    low, high = sorted((find(a), find(b)))
                    top[high] = low
    rows = spark.createDataFrame([(k, " ".join(m)) for k, (_, m) in enumerate(docs)], "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(rows).collect()}
    assert got == {k: find(k) for k in range(len(docs))}
