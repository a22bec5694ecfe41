"""Operators 11 to 13 against brute force, on small frames with nulls, empty, long, equal and repeated rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from odoflow.llm import align, syncmers, variants
from odoflow.llm.common import Scratch
from odoflow.llm.queries import QUERIES
from odoflow.llm.tokens import _printable_bytes

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977} x{i % 31}" for i in range(20_000))
BASE = "the quick brown fox jumps over the lazy dog while seven small cats sleep under an old warm stone bridge near town"
ROWS = [
    (1, BASE), (2, BASE), (3, None), (4, ""), (5, " \n\t "), (6, LONG), (7, LONG + " end"), (8, "A b C d"), (8, "A b C d"),
    (None, "no id here"), (None, None), (9, "a\nb\n\na " + BASE + "\nnaïve café É"), (10, BASE.upper()), (11, "x▁y marks"),
    (12, "emoji \U0001f600\U0001f600 and　wide ½ ²" * 3), (13, "<|endoftext|> <0x41> </s> <unk>"), (14, "two  spaces   three  "), (15, "z"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "pair", 1, "block") for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, pair string, slot int, key string")


# ---------------------------------------------------------------- op11


def aligned_by_hand(texts):
    """Each text's (n_a, n_b, n_groups, links, digest), from the libraries' own whole encodings."""
    a_lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    code = {c: b for b, c in _printable_bytes().items()}

    def spans(ids, piece):
        out, at = [], 0
        for i in ids:
            out.append((at, at + len(piece(i)), i))
            at = out[-1][1]
        return out, b"".join(map(piece, ids))

    def b_bytes(i):
        p = b_lib.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()

    for text in texts:
        a, a_raw = spans(a_lib.encode(" " + (text or ""), add_special_tokens=False).ids, lambda i: bytes(code[c] for c in a_lib.id_to_token(i)))
        b, b_raw = spans(b_lib.encode(text or ""), b_bytes)
        if not text or not a_raw == b_raw == (" " + text).encode():
            yield 0, 0, 0, [], ""
            continue
        owner, links = {}, []
        for k, (lo, hi, _) in enumerate(b):
            owner.update(dict.fromkeys(range(lo, hi), k))
        for lo, hi, i in a:
            links += [(i, b[k][2]) for k in sorted({owner[p] for p in range(lo, hi)})]
        cuts = sorted({x[1] for x in a} & {x[1] for x in b})
        where = {e: k for k, e in enumerate(cuts)}
        groups, at = [([], []) for _ in cuts], [0, 0]
        for side, tokens in enumerate((a, b)):
            for _, hi, i in tokens:
                groups[at[side]][side].append(str(i))
                at[side] += hi in where
        digest = hashlib.sha256(";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups).encode()).hexdigest()
        yield len(a), len(b), len(cuts), links, digest


def check_alignment(frame, **kw):
    rows = frame.select("doc_id", "text").collect()
    by_hand = list(aligned_by_hand([r.text for r in rows]))
    count, docs_of = Counter(p for x in by_hand for p in x[3]), Counter(p for x in by_hand for p in set(x[3]))
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    want = sorted(
        (str(r.doc_id), na, nb, g, len(links), d, sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links))
        for r, (na, nb, g, links, d) in zip(rows, by_hand)
    )
    job = align.Alignment(frame, **kw)
    assert sorted((str(r[0]), *r[1:]) for r in job.documents().collect()) == want
    assert {(r.a_id, r.b_id): (r.docs, r.links) for r in job.pairs.collect()} == {p: (docs_of[p], n) for p, n in count.items()}
    return job


def test_alignment_equals_brute_force(spark, docs):
    check_alignment(docs)
    some = spark.read.parquet(f"{SF}/documents.parquet").where(F.length("text") < 4000)
    job = check_alignment(some.repartition(3), postings=2_000)
    assert job.index.select("block").distinct().count() >= 3


def test_alignment_of_many_blocks(spark, monkeypatch, docs):
    monkeypatch.setattr(align, "_TOKENS", 500)  # also seen by forked workers started later; results do not depend on it
    check_alignment(docs.repartition(2), postings=100)


def test_alignment_of_no_rows(docs):
    assert align.Alignment(docs.limit(0)).documents().isEmpty()


def test_long_texts_are_cut_without_effect(monkeypatch):
    whole = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    monkeypatch.setattr(align, "_LONG", 5)
    ours = align.PieceEncoder(public_tokenizers.path("piece_bpe_32k.model"))
    for text in [t for _, t in ROWS if t and len(t) < 3000] + ["a ", "a  ", "     ", " a b  c ", "abc def ghi jkl  "]:
        assert ours.encode(text).tolist() == whole.encode(text)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.tuples(st.integers(0, 5), st.one_of(st.integers(0, 65535), st.integers(0, 40))), st.integers(1, 70_000), min_size=1, max_size=200))
def test_planes_give_back_what_was_packed(counts):
    keys = sorted(counts)
    pair, slot, times = (np.array(x, np.int64) for x in ([k[0] for k in keys], [k[1] for k in keys], [counts[k] for k in keys]))
    pairs, docs, links, planes = align.pack(pair, slot.astype("<u2"), times)
    back = Counter()
    for row, at, weight in align.unpack(planes):
        for r, s, w in zip(row, at, np.broadcast_to(weight, len(row))):
            back[int(pairs[r]), int(s)] += int(w)
    assert back == counts
    assert docs.tolist() == [sum(k[0] == p for k in keys) for p in pairs]
    assert links.tolist() == [sum(n for k, n in counts.items() if k[0] == p) for p in pairs]


def test_dense_bitmaps_are_written_as_bits():
    slot = np.arange(0, 60_000, 2)
    pairs, docs, links, planes = align.pack(np.full(len(slot), 9), slot.astype("<u2"), np.where(slot % 4 == 0, 3, 1))
    assert len(planes[0].as_py()) == 2 * (4 + 4096 * 2) and docs[0] == 30_000 and links[0] == 60_000
    assert sum(int(np.sum(w)) for _, _, w in align.unpack(planes)) == 60_000


# ---------------------------------------------------------------- op12


def hashed(spark, strings):
    rows = spark.createDataFrame([(s,) for s in strings], "s string").select("s", F.xxhash64("s").alias("h")).collect()
    return {r.s: r.h for r in rows}


def test_anchors_are_the_closed_syncmers(spark, docs):
    texts = [t for _, t in ROWS if t and len(t) < 6000] + [(BASE + "\U0001f600 ") * 60]
    h = hashed(spark, {t[i : i + syncmers.S] for t in texts for i in range(len(t))})
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", syncmers.anchors(F.col("t")).alias("a")).collect()
    k, s = syncmers.K, syncmers.S
    for r in got:
        want = []
        for i in range(len(r.t) - k + 1):
            inner = [h[r.t[j : j + s]] for j in range(i, i + k - s + 1)]
            if min(inner) in (inner[0], inner[-1]):
                want.append(i)
        assert [x & ((1 << 30) - 1) for x in r.a] == want


def test_fingerprints_of_edited_and_next_texts(spark, docs):
    extra = spark.createDataFrame([(100 + i, " ".join(f"{BASE[i:]} {i}{j}" for j in range(i))) for i in range(40)], "doc_id long, text string")
    frame = docs.select("doc_id", "text").unionByName(extra)
    got = syncmers.fingerprints(frame).collect()
    rows = sorted(((r.doc_id, r.text or "") for r in frame.collect()), key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest()))
    want = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        q = len(text) // 4
        want.append((doc_id, text, text[: len(text) - q] + following[:q], following))
    plain = spark.createDataFrame(want, "doc_id long, text string, edited string, following string")
    own, changed, after = (syncmers.sketch(F.col(c)) for c in ("text", "edited", "following"))
    plain = plain.select("doc_id", F.length("text").cast("long").alias("n"), F.sha2("edited", 256).alias("sha"), own.alias("o"), changed.alias("c"), after.alias("f"))
    near = [syncmers.likeness(F.col("o"), F.col(x)).alias(f"near_{x}") for x in "cf"]
    plain = plain.select("doc_id", "n", "sha", syncmers.written(F.col("o")).alias("fp"), syncmers.written(F.col("c")).alias("fc"), *near).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, map(tuple, plain)))
    by_text = defaultdict(set)
    for r, (_, text, _, _) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0)), want):
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    for r in plain:
        by_text[r[0]].add(r[3])
    assert by_text[1] == by_text[2] and len(by_text[1]) == 1


def test_likeness_follows_the_shared_part(spark):
    words = [f"{hashlib.md5(str(i).encode()).hexdigest()[: 3 + i % 7]}" for i in range(4000)]
    text, other = " ".join(words[:2000]), " ".join(words[2000:])
    pairs = [(text, text), (text, other), (text, "short lead " + text), (text, text[: len(text) // 2] + other[: len(text) // 2]), ("", ""), ("", "a"), ("abc", "abc"), ("abc", "abd")]
    got = spark.createDataFrame(pairs, "a string, b string").select(syncmers.likeness(syncmers.sketch(F.col("a")), syncmers.sketch(F.col("b"))).alias("x")).collect()
    x = [r.x for r in got]
    assert x[0] == 1 and x[1] < 0.05 and x[2] > 0.95 and 0.3 < x[3] < 0.7 and x[4:] == [1, 0, 1, 0]


def test_successors_across_chunks_with_repeated_and_null_ids(spark):
    rows = [(None if i % 3 == 0 else i // 5 * 1000 - 7, f"t{i}") for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.sha2("text", 256))
    got = syncmers.next_in_order(frame, {"text": F.col("text")}, Scratch(spark, "test"), rows=16).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest()))
    want = {order[i][1]: order[(i + 1) % len(order)][1] for i in range(len(order))}
    assert {r.text: r.next.text for r in got} == want


def test_fingerprints_of_one_and_no_rows(spark, docs):
    assert syncmers.fingerprints(docs.limit(0)).isEmpty()
    one = syncmers.fingerprints(spark.createDataFrame([(5, BASE)], "doc_id long, text string")).first()
    assert one.near_next == 1 and one.n_chars == len(BASE)


# ---------------------------------------------------------------- op13


def variants_by_hand(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    links = {w: [x for x in words if near(w, x)] for w in words}
    form = {w: min(links[w], key=lambda x: (-words[x], x)) for w in words if links[w]}
    form = {w: x for w, x in form.items() if words[x] >= 10 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(links[w]), words.get(form.get(w))) for w, n in words.items())


def test_variants_equal_brute_force(spark, docs):
    made = [(i, " ".join(["Kitchens"] * 300 + ["kitchns"] * 20 + ["kitchnss"] + ["Éclairée", "éclairée", "ABCDEFGH", "bcdefgh"] * 2)) for i in range(3)]
    made += [(None, "kitchens kitchans kitchans"), (None, "a" * 9000 + " " + "a" * 8999), (4, "a" * 9000 + " " + "a" * 8999), (5, None), (6, "")]
    frame = docs.select("doc_id", "text", "key").unionByName(spark.createDataFrame([(i, t, "word") for i, t in made], "doc_id long, text string, key string"))
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    got = sorted(map(tuple, variants.variants(frame).collect()), key=lambda r: r[0])
    assert got == variants_by_hand(rows)
    assert any(r[1] is not None and r[2] != r[1] for r in got)  # a chain of forms


def test_variants_of_a_table(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    assert sorted(map(tuple, variants.variants(frame).collect()), key=lambda r: r[0]) == variants_by_hand(rows)


def test_hot_chunks_are_dealt_in_blocks_without_loss(spark):
    words = spark.createDataFrame([(f"prefix{a}{b}{c}", 2 + (ord(a) + ord(b)) % 5) for a in "abcdefgh" for b in "abcdefgh" for c in "xyz"], "word string, n long")
    whole, dealt = (sorted(map(tuple, variants.near_pairs(words, block=b).collect())) for b in (10_000, 7))
    assert whole == dealt and len(whole) == 192 * (7 + 7 + 2) // 2


def test_variants_of_no_rows(docs):
    assert variants.variants(docs.limit(0)).isEmpty()


@pytest.mark.parametrize("key", ["op11_alignment", "op12_fingerprints", "op13_variants"])
def test_registered_queries_have_the_contract_columns(spark, key):
    want = {
        "op11_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"],
        "op12_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        "op13_variants": ["word", "form", "root", "n", "n_near", "form_n"],
    }
    assert QUERIES[key](spark, SF).columns == want[key]
