"""The training-data operators against brute force, round trips and held-out accuracy, on small frames."""

from __future__ import annotations

import glob
import hashlib
import json
import math
import os
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from odoflow.llm import exact, golay, hmm, linedup, packing, quality, rans, simhash, tokens, toolcalls, toxicity, winnow
from odoflow.llm.common import Scratch
from odoflow.llm.components import components

SF = "/root/testdata/sf0.01"
LONG = " ".join(f"w{i % 977} x{i % 31}" for i in range(30_000))
BASE = "the quick brown fox jumps over the lazy dog while seven small cats sleep under an old warm stone bridge near town"
ROWS = [
    (1, BASE), (2, BASE), (3, None), (4, ""), (5, " \n\t "), (6, LONG), (7, LONG + " end"), (8, "A b C d"), (8, "A b C d"),
    (None, "no id here"), (9, "a\nb\n\na " + BASE + "\nnaïve café É"), (10, BASE.upper()), (11, "it's we'll 's don'T  x  \n y9_8--z"),
    (12, "emoji \U0001f600 and 　wide ½ ²"), (13, BASE + " tail"), (14, "<|endoftext|> stays text"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty, very long, equal and repeated rows; extra columns with names the operators use themselves."""
    rows = [(i, t, "key", 1, "bucket") for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, kept int, fp string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# ---------------------------------------------------------------- tokens, op1, op6


def library_ids(texts):
    t = tokens.encoder().tokenizer
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from(list("ab'sle \n\t9_-É\x1c\x85½’　")), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_remembered_pieces_equal_the_library(text):
    assert np.frombuffer(tokens.encoder().ids(text), "<u4").tolist() == library_ids([text])[0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(list("ab'sdlvreS2 \n\t9_-É\x00\x1c\x1f½’　")), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=6), st.sampled_from([8, 1 << 20]))
def test_pieces_of_many_texts_equal_the_library(texts, size):
    old, tokens.SLICE = tokens.SLICE, size
    try:
        got = list(tokens.encoder().ids_of(texts))
    finally:
        tokens.SLICE = old
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == library_ids(texts)


@pytest.mark.parametrize("text", ["it's we'll I've you're I'd I'm can't 'street 'llama ''s !'s 's x 's\n't '", "a  b", "  a", "a  ", "a \n b\n\n  c\r\n", " \n", "é's à ÿ'll", "9'd1 'x2'm"])
def test_split_points_on_bytes(text):
    said = [text, "", text[::-1], text + " " + text]
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.encoder().ids_of(said)] == library_ids(said)


def test_each_distinct_piece_of_many_texts_is_looked_up_once(monkeypatch):
    enc, asked = tokens.encoder(), []
    want, known = [enc.ids(t) for t in ["the cat the", "the cat"] * 50], enc.known

    class Asked(dict):
        def __missing__(self, piece):
            asked.append(piece)
            return known[piece]

    monkeypatch.setattr(enc, "known", Asked())
    assert list(enc.ids_of(["the cat the", "the cat"] * 50)) == want
    assert sorted(asked) == [tokens.END, " cat", " the", "the"]


def test_pieces_survive_the_change_of_generations(monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 8)
    small = tokens._Known(tokens.encoder().tokenizer.model)
    pieces = [" a", "bc", "\n\n", "é", " déjà", "\x00", "9", " zq", "~", "!?", " a", "bc"] * 3
    for p in pieces:
        want = np.array(tokens.encoder().tokenizer.encode(p, add_special_tokens=False).ids, "<u4").tobytes()
        assert small[p] == want and len(small) <= 4 and len(small.older) <= 4


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y <|endoftext", "é <|endoftext|> 　"])
def test_added_tokens_are_those_of_the_library(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER)).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokens.encoder().ids(text), "<u4").tolist() == [*plain, 0]
    assert 50256 in plain


def test_token_files_round_trip(spark, docs, empty):
    path = Scratch(spark, "test").path("files")
    rans.write_token_files(docs, path, block_tokens=500)
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in rans.read_token_files(spark, path).collect()))
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for (doc, _), ids in zip(rows, library_ids([t for _, t in rows])):
        raw = np.array(ids, "<u4").tobytes()
        want.append((doc is not None, doc or 0, start, len(ids), zlib.crc32(raw), raw))
        start += len(ids)
    assert got == sorted(want)
    path = Scratch(spark, "test").path("none")
    rans.write_token_files(empty, path)
    assert rans.read_token_files(spark, path).count() == 0


def test_payload_checkpoints_and_checksum():
    ids = (np.random.default_rng(0).zipf(1.2, 90_000) % 5000).astype(np.uint32)
    table_ = rans.Table.scaled(*(x.astype(float) if k else x for k, x in enumerate(np.unique(ids, return_counts=True))))
    payload = rans.encode_payload(ids, table_)
    assert np.array_equal(rans.decode_payload(payload, table_), ids)
    stretch = rans.LANES * rans.CHECKPOINT_STEPS
    assert np.array_equal(rans.decode_payload(payload, table_, 1, 2), ids[stretch : 2 * stretch])
    broken = bytearray(payload)
    broken[-5] ^= 1
    with pytest.raises(ValueError):
        rans.decode_payload(bytes(broken), table_)


def check_packing(rows, texts, size):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for ids_of, found in ((library_ids([t])[0], by_doc[d]) for d, t in texts.items()):
        found.sort(key=lambda r: r.piece)
        assert [r.piece for r in found] == list(range(len(found))) and sum(r.length for r in found) == len(ids_of)
        assert all(r.length == size for r in found[1:])
        for r in found:
            assert r.ids_crc32 == zlib.crc32(np.array(ids_of[r.start : r.start + r.length], "<u4").tobytes())
    for found in by_sequence.values():
        found.sort(key=lambda r: r.offset)
        assert [r.offset for r in found] == [sum(x.length for x in found[:k]) for k in range(len(found))]
        assert sum(r.length for r in found) <= size


def test_packing(spark, docs, empty):
    rows = packing.pack(docs, max_tokens=64).collect()
    texts = dict(r for r in ROWS if r[0] != 8)
    check_packing(packing.pack(docs.where("doc_id != 8 or doc_id is null"), 64).collect(), texts, 64)
    assert sum(r.doc_id == 8 for r in rows) == 2
    assert packing.pack(empty).count() == 0


def test_packing_equals_best_fit_decreasing_with_a_hot_size():
    sizes = Counter(np.random.default_rng(3).integers(1, 2048, 3000).tolist()) + Counter({700: 1500})
    quota = packing.Quota(sizes, 2048)
    rooms, used = Counter(), 0
    for size in sorted(sizes.elements(), reverse=True):
        room = min((r for r, n in rooms.items() if n and r >= size), default=None)
        used += room is None
        rooms[room] -= room is not None
        rooms[(room or 2048) - size] += 1
    assert quota.used == used
    assert {k: sum(n for _, n, _, _ in v) for k, v in quota.slots.items()} == dict(sizes)


# ---------------------------------------------------------------- op2


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_groups(docs, bits):
    got = sorted((r.doc_id or -1, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.exact_groups(docs, capacity=2, hash_bits=bits).collect())
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[t or ""].append(i)
    want = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i or -1, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    assert got == sorted(want)


def test_directory_splits_until_no_bucket_is_overfull(spark):
    keys = spark.range(500).select(F.xxhash64("id").alias("key"))
    scratch = Scratch(spark, "test")
    directory, depth = exact.build_directory(keys, scratch, capacity=20)
    assert directory.count() == 1 << depth
    loads = keys.withColumn("cell", F.shiftrightunsigned("key", 64 - depth)).join(directory, "cell").groupBy("bucket").count().collect()
    assert max(r["count"] for r in loads) <= 20 and sum(r["count"] for r in loads) == 500


def test_exact_groups_of_nothing(empty):
    assert exact.exact_groups(empty).count() == 0


# ---------------------------------------------------------------- op3


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = int(rng.integers(1 << 21))
        b = a
        for bit in rng.choice(21, 2, replace=False):
            b ^= 1 << int(bit)
        first, count, keys = golay.keys(np.array([a, b]), 21)
        assert set(keys[: count[0]]) & set(keys[first[1] :])


def brute_components(values, most):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("block", [4096, 5])
def test_links_connect_all_near_fingerprints(spark, block):
    rng = np.random.default_rng(2)
    values = set()
    for _ in range(12):
        centre = int(rng.integers(1 << 63))
        for _ in range(15):
            v = centre
            for bit in rng.choice(64, int(rng.integers(0, 6)), replace=False):
                v ^= 1 << int(bit)
            values.add(v - (1 << 64) if v >> 63 else v)
    values = sorted(values)
    scratch = Scratch(spark, "test")
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r.node: r.root for r in components(simhash.links(nodes, scratch, 4, block), scratch).collect()}
    unsigned = [v % (1 << 64) for v in values]
    assert [got.get(v, v) for v in values] == [values[i] for i in brute_components(unsigned, 4)]


def test_near_duplicates(docs, empty):
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    prints = []
    for _, t in ROWS:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    least = {}
    for (i, _), r in zip(ROWS, brute := brute_components(prints, 4)):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = sorted(((i is not None, i or 0, f"{p:016x}", least[r]) for (i, _), p, r in zip(ROWS, prints, brute)), key=str)
    assert got == want
    assert simhash.near_duplicates(empty).count() == 0


def test_tidy_tables_leave_no_shuffle_files(spark):
    def files():
        folders = [str(f) for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
        return {os.path.basename(f) for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}

    before, saved = files(), Scratch(spark, "test", tidy=True).save(spark.range(1000).repartition(3, "id"), "rows")
    deadline = time.monotonic() + 20  # they go in the background
    while files() - before and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not files() - before and saved.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    assert linedup.LineDedup(spark.createDataFrame([(1, "a b")], "doc_id long, text string")).scratch.tidy


# ---------------------------------------------------------------- op4, op7


def held_out_auc(spark, module, label):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    rows = module.score(docs, module.train(docs, labels)).join(labels, "doc_id").select("held_out", "score", F.col(label).alias("y")).collect()
    assert all(0 <= r.score <= 1 for r in rows)
    z, y = np.array([r.score for r in rows]), np.array([r.y for r in rows])
    rank = np.argsort(np.argsort(z))
    return (rank[y == 1].mean() - (y == 1).sum() / 2) / (y == 0).sum()


def test_quality_separates(spark):
    assert held_out_auc(spark, quality, "quality") > 0.8


def test_toxicity_separates(spark):
    assert held_out_auc(spark, toxicity, "toxic") > 0.8


def test_toxicity_trains_on_every_row(spark):
    """What is toxic only in rows that the first 1,500 of a label (by the hash of the id) leave out is learnt too."""
    spread = spark.range(4600).select("id", F.xxhash64("id").alias("h")).where("crc32(cast(id as string)) % 4 != 2").orderBy("h").collect()
    toxic = [r.id for r in spread if r.id % 2][:1650]
    late, rng = set(toxic[1500:]), np.random.default_rng(3)

    def text(i):
        said = [f"word{k}" for k in rng.integers(0, 60, 12)]
        return " ".join([*said, "zorgle" if i in late else "vile" if i in toxic else "mild"])

    rows = [(r.id, text(r.id), int(r.id in toxic)) for r in spread]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, y int"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    found = {r.doc_id: r.predicted for r in toxicity.score(docs.drop("y"), toxicity.train(docs.drop("y"), labels)).collect()}
    assert len(late) == 150 and sum(found[i] for i in late) > 140
    assert sum(found[i] != y for i, _, y in rows) < 0.02 * len(rows)


def test_toxicity_passes_meet_in_the_weighted_mean(spark):
    """Two tasks' states, summed by Spark, are their mean weighted by rows; embeddings by the occurrences of their buckets."""
    rng = np.random.default_rng(5)
    rows = [(k % 2, *([[int(b) for b in rng.integers(0, 50, 9)]] * 3)) for k in range(40)]
    lanes, schema = (rows[:30], rows[30:]), "y int, b0 array<short>, b1 array<short>, b2 array<short>"
    known = spark.sparkContext.broadcast(toxicity.Fit().state())
    sent, weights, totals = "lane int, chunk int, weight binary, total binary", [], []
    both = None
    for lane, part in enumerate(lanes):
        got = spark.createDataFrame(part, schema).coalesce(1).mapInArrow(toxicity._pass(known, 11), sent)
        got = got.withColumn("lane", F.lit(lane)).localCheckpoint()
        both = got if both is None else both.unionByName(got)
        held = sorted((r.chunk, bytes(r.weight), bytes(r.total)) for r in got.collect())
        weights.append(np.concatenate([np.frombuffer(w) for _, w, _ in held]))
        totals.append(np.concatenate([np.frombuffer(t).reshape(-1, 3 * toxicity.DIM) for *_, t in held]))
        assert weights[-1][-1] == len(part) and round(weights[-1][: toxicity.BUCKETS].sum()) == 27 * len(part) + 33
    means = both.repartition("chunk").sortWithinPartitions("chunk", "lane").mapInArrow(toxicity._summed, "chunk int, mean binary").collect()
    got = np.concatenate([np.frombuffer(r["mean"]).reshape(-1, 3 * toxicity.DIM) for r in sorted(means)])
    assert np.array_equal(got, (totals[0] + totals[1]) / (weights[0] + weights[1])[:, None])
    assert toxicity.Fit(got).step == (30 * 1 + 10 * 1) / 40


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifier_edges(spark, docs, empty, module, label):
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    few = spark.createDataFrame([(i, i % 2) for i in range(1, 15)] + [(None, 1), (3, None)], f"doc_id long, {label} int")
    for labels in (none, few):
        rows = module.score(docs, module.train(docs, labels)).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert {r.held_out for r in rows if r.doc_id == 1} == {zlib.crc32(b"1") % module.MODULUS == module.HELD}
    assert module.score(empty, module.train(empty, none)).count() == 0


def test_quality_dictionaries_know_the_whole_sample():
    rng = np.random.default_rng(4)

    def texts(passage):
        return [f"{passage} {rng.integers(1 << 40)} {passage.upper()} {rng.bytes(500).hex()}".encode() for _ in range(90)]

    first, last = texts("the first passage of all good texts"), texts("another passage of the later texts")  # some 100 KB each
    for few in (last[:20], last[:1], last):
        both, short = quality._dictionaries(first + last, few)
        assert b"first passage" in both and b"later texts" in both and len(both) <= quality.DICTIONARY_BYTES
        assert len(short) <= quality.DICTIONARY_BYTES and (len(few) > 20 or short == b"".join(few))
    assert quality._dictionaries(first[:3], last[:5]) == [b"".join(first[:3]), b"".join(last[:5])]


# ---------------------------------------------------------------- op5


def test_forward_is_the_sum_over_all_paths():
    model = hmm.Hmm(np.full(hmm.Classes.count, 1 / hmm.Classes.count), seed=9)
    x = np.array([3, 700, 1023])
    total = sum(
        model.start[a] * model.emit[a, 3] * model.move[a, b] * model.emit[b, 700] * model.move[b, c] * model.emit[c, 1023]
        for a in range(hmm.STATES) for b in range(hmm.STATES) for c in range(hmm.STATES)
    )
    assert model.log10([x, x[:1]])[0] == pytest.approx(math.log10(total))
    starts, moves, emissions = model.expected([x, x[:2], x[:1]])
    assert (starts.sum(), moves.sum(), emissions.sum()) == pytest.approx((3, 3, 6), rel=1e-4)


@pytest.mark.parametrize("head", [1 << 18, 5])
def test_base_score(docs, empty, head):
    toks = [[*(t or "").encode().lower().split(), b""] for _, t in ROWS]
    held = [zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2 for i, _ in ROWS]
    c = Counter(w for t, h in zip(toks, held) if not h for w in t)
    floor = sum(c.values()) + len(c) + 1
    want = sorted((i or -1, h, len(t), sum(c[w] > 0 for w in t), sum(c.values()), round(sum(math.log10((c[w] + 1) / floor) for w in t), 5)) for (i, _), t, h in zip(ROWS, toks, held))
    rows = hmm.score_texts(docs, rounds=1, head=head).collect()
    assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert hmm.score_texts(empty).count() == 0


def test_hmm_training_beats_the_base_on_held_out_documents(spark):
    sums = hmm.score_texts(table(spark, "documents")).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (sums[0] - sums[1]) / sums[2] > 0.05


# ---------------------------------------------------------------- op8


def test_line_dedup(spark, docs, empty):
    some = table(spark, "documents").where("doc_id < 150").select("doc_id", "text")
    for frame in (some, docs.select("doc_id", "text").where("doc_id is not null").distinct()):
        rows = sorted(frame.collect(), key=lambda r: r.doc_id)
        seen, want = [], {}
        for r in rows:
            lines, kept = (r.text.split("\n") if r.text is not None else []), []
            for line in lines:
                s = frozenset(line.encode().lower().split())
                if not s or not any(len(s & t) / len(s | t) >= 0.8 - 1e-9 for t in seen):
                    kept.append(line)
                if s:
                    seen.append(s)
            want[r.doc_id] = (len(lines), len(lines) - len(kept), "\n".join(kept))
        assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in linedup.LineDedup(frame).report().collect()} == want
    assert linedup.LineDedup(docs).report().count() == len(ROWS)
    assert linedup.LineDedup(empty).report().count() == 0


def test_line_dedup_finds_matches_far_back(spark):
    """Many lines share one rare word but match nothing, and the match stands before them all."""
    rows = [(0, "rare a b c d e f g h")] + [(i, f"rare p{i} q{i} r{i} s{i} t{i} u{i} v{i} w{i}") for i in range(1, 40)] + [(40, "rare a b c d e f g z")]
    got = {r.doc_id: r.n_removed for r in linedup.LineDedup(spark.createDataFrame(rows, "doc_id long, text string")).report().collect()}
    assert got == {i: int(i == 40) for i in range(41)}


def test_line_dedup_does_not_depend_on_the_order_of_rows(spark):
    """Copies and variants of lines, dealt over partitions backwards; very long and many lines; signatures of all words."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, "\n".join([" ".join(words[: 50 + i % 7]), "same", " ".join(reversed(words)), f"only{i} " + " ".join(words[:3])])) for i in range(40)]
    rows.append((40, " ".join(f"v{i % 5000}" for i in range(200_000))))
    rows.append((41, " ".join(f"V{i}" for i in range(4800))))
    frames = [spark.createDataFrame(r, "doc_id long, text string").repartition(n, "text") for r, n in ((rows, 1), (rows[::-1], 7))]
    got = [sorted(tuple(r) for r in linedup.LineDedup(f).report().collect()) for f in frames]
    assert got[0] == got[1]
    # 50 and 60 words match (50 / 60 > 0.8); of the last lines each has a word of its own, and 3 of 5 are shared.
    assert [r[2] for r in got[0]] == [1, *[3] * 39, 0, 1]


def test_line_dedup_counts_without_ansi_mode(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        rows = [(1, "a b c\nx"), (2, "a b c"), (3, None)]
        got = linedup.LineDedup(spark.createDataFrame(rows, "doc_id long, text string")).report().collect()
        assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in got} == {1: (2, 0, "a b c\nx"), 2: (1, 1, ""), 3: (0, 0, "")}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_line_dedup_in_many_rounds(spark, monkeypatch):
    """Sweeps that look back two places and take one pair of a posting: later rounds find the rest, with both signatures equal."""
    monkeypatch.setattr(linedup, "REACH", 2)
    monkeypatch.setattr(linedup, "MOST", 1)
    monkeypatch.setattr(linedup, "STEP", 2)
    rows = [(i, " ".join([f"Rare{i % 3}", *(f"w{(i * k) % 11}" for k in range(1, 9))])) for i in range(60)]
    seen, want = [], {}
    for i, text in rows:
        line = frozenset(text.lower().split())
        want[i] = int(any(len(line & x) / len(line | x) >= 0.8 - 1e-9 for x in seen))
        seen.append(line)
    got = {r.doc_id: r.n_removed for r in linedup.LineDedup(spark.createDataFrame(rows, "doc_id long, text string")).report().collect()}
    assert got == want and 0 < sum(want.values()) < 60


def test_line_dedup_sweep_keeps_nothing_of_lines_without_a_pair():
    """Postings of one word in lines that can't match leave no rows for a next round; the tables hold no texts."""
    n = 40
    signs = np.random.default_rng(1).integers(-(2**63), 2**63, n)
    rows = {"key": np.full(n, (7 << 32) | 9), "number": np.arange(n), "place": np.zeros(n, np.int32), "sign": signs, "open": np.ones(n, bool)}
    batch = pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in rows.items()})
    assert sum(b.num_rows for b in linedup._sweep(256, 32, 0.8)(iter([batch.slice(0, 25), batch.slice(25)]))) == 0
    assert "string" not in linedup._LINES
    same = batch.set_column(3, "sign", pa.array(np.zeros(n, np.int64)))
    found = [r for b in linedup._sweep(256, 32, 0.8)(iter([same.slice(0, 25), same.slice(25)])) for r in b.to_pylist()]
    pairs = [(r["later"], r["earlier"]) for r in found if r["earlier"] is not None]
    assert len(pairs) == len(set(pairs)) and all(a > b for a, b in pairs)
    assert {r["later"] for r in found if r["word"] is not None} >= set(range(33, n))  # those with more than 32 pairs


def test_line_dedup_words_and_lines():
    """Words by white space of all kinds, A-Z lower-cased, of any length; rows and numbers of lines, null and empty texts too."""
    texts = ["Ab ab\tx" + "y" * 30 + "\n\n X" + "Y" * 30 + " \x0b\u00c4b", None, "", "ab\n"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    found = list(linedup._lines(batch))
    assert [(r, k) for row, number, _, _ in found for r, k in zip(row.tolist(), number.tolist())] == [(0, 0), (0, 1), (0, 2), (1, 0), (2, 0), (3, 0), (3, 1)]
    (_, _, data, ends), = found
    hashes, before = linedup._words(data, ends)
    assert before.tolist() == [3, 3, 5, 5, 5, 6, 6]
    assert hashes[0] == hashes[1] == hashes[5] and hashes[2] == hashes[3] and len(set(hashes.tolist())) == 3


# ---------------------------------------------------------------- op9


@pytest.mark.parametrize(("text", "problem"), [
    ("[" * 200_000, "$: nested too deeply"), ('{"a":' * 501 + "1" + "}" * 501, "$: nested too deeply"), ('{"a":"\\ud800"}', "$: half a surrogate pair"),
    ('{"a":' + "9" * 10_000 + "}", "$: no JSON"), ("", "$: no JSON"), ('{"a":"\\ud83d\\ude00"}', ""), ('{"a":"[[[\\"[["}', ""), ('{"a":[' + "[],[{}]," * 5000 + "1]}", ""),
    ("[" * 500 + "]" * 500, ""),
])
def test_arguments_that_cannot_be_written_stay_text(text, problem):
    value, found = toolcalls.read_arguments(text)
    assert found == problem
    assert value == (text if problem else json.loads(text))
    assert toolcalls.canonical({"arguments": value}).encode()


def test_tool_calls(spark):
    messages = spark.createDataFrame([(1, 0, "user", "hi \"x\"\n"), (1, 1, None, None)], "conv_id long, turn long, role string, text string")
    calls = spark.createDataFrame(
        [(1, 1, "a", "t", '{"n": 3, "b": [1]}', []), (1, 1, "a", "t", '{"n": 3, "b": [1]}', []), (1, 1, "b", "t", '{"n": "3"}', ["a"]), (1, 2, "c", "t", "{", ["a", "b"]),
         (1, 2, "d", "u", "[]", ["e"]), (1, 2, "e", "t", '{"n": 9}', ["d"]), (1, 3, "f", "t", None, ["gone"]), (None, 1, "a", "t", "{}", None)],
        "conv_id long, turn long, call_id string, name string, arguments string, after array<string>",
    )
    results = spark.createDataFrame([(1, 2, "a", "z"), (1, 2, "a", "y"), (1, 3, "lost", None)], "conv_id long, turn long, call_id string, content string")
    schemas = {"t": {"required": ["n"], "properties": {"n": {"type": "integer", "maximum": 5}}}}
    rows = toolcalls.link_and_format(messages, calls, results, schemas).collect()
    by = {(r.kind, r.conv_id, r.call_id): r for r in rows if r.kind != "message"}
    assert len(rows) == 2 + 7 + 2
    assert {k[2]: r.level for k, r in by.items() if k[:2] == ("call", 1)} == {"a": 0, "b": 1, "c": 2, "d": None, "e": None, "f": None}
    assert {k[2]: r.fault for k, r in by.items() if k[:2] == ("call", 1)} == {
        "a": "", "b": "$.n: not integer", "c": "$: no JSON", "d": "unknown tool", "e": "$.n: out of range", "f": "$: no JSON"}
    assert by["call", 1, "a"].linked and not by["call", 1, "b"].linked and not by["result", 1, "lost"].linked
    assert by["call", 1, "a"].json == '{"arguments":{"b":[1],"n":3},"id":"a","name":"t"}'
    assert by["result", 1, "a"].json == '{"call_id":"a","content":"y"}'
    assert sorted(json.loads(r.json)["content"] for r in rows if r.kind == "message") == ["", 'hi "x"\n']
    assert toolcalls.link_and_format(messages.limit(0), calls.limit(0), results.limit(0), {}).count() == 0


# ---------------------------------------------------------------- op10


def test_winnowing(spark, docs, empty):
    items = spark.createDataFrame(
        [(1, BASE), (1, BASE), (2, "b c d"), (3, ""), (4, None), (None, "no id here"), (5, " ".join(LONG.split()[100:140])), (6, "x"), (7, "never seen words " * 9)],
        "item_id long, text string",
    )
    windows = defaultdict(set)

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    for r in items.collect():
        w = words(r.text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add(r.item_id)
    sizes, want = {len(k) for k in windows}, []
    for d, t in ROWS:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])] - {None}
        want.append((d or -1, len(w), len(hit), len(found), ",".join(sorted(map(str, found))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    found = winnow.Winnowing(docs, items)
    got = sorted((r.doc_id or -1, r.n_words, r.n_hit, r.n_items, r.item_ids, r.contaminated) for r in found.report().collect())
    assert got == sorted(want)
    assert winnow.Winnowing(empty, items).report().count() == 0
    assert {r.n_hit for r in winnow.Winnowing(docs, items.limit(0)).report().collect()} == {0}


def test_winnowing_tells_rows_with_one_id_apart(spark):
    rows = [(None, BASE), (None, "clean and short"), (None, "clean " * 30), (7, BASE), (7, "clean words only"), (7, BASE)]
    items = spark.createDataFrame([(1, BASE)], "item_id long, text string")
    found = winnow.Winnowing(spark.createDataFrame(rows, "doc_id long, text string"), items).report().collect()
    hit = len(BASE.split())
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in found) == Counter(
        (i, len(t.split()), hit * (t == BASE), int(t == BASE), t == BASE) for i, t in rows
    )


# ---------------------------------------------------------------- pipeline


def test_pipeline_decides_on_rows_not_ids(spark, monkeypatch):
    """Rows without an id and repeated ids: only flagged rows go, and one row of each group stays."""
    import corpus_pipeline as p

    other = " ".join(f"u{i}" for i in range(40))
    rows = [
        (None, BASE, "a"), (None, "all alone", "b"), (None, other, "d"), (None, other, "c"), (1, BASE, "e"), (2, BASE, "f"),
        (3, "same id one", "g"), (3, BASE, "h"), (4, "equal rows", "j"), (4, "equal rows", "i"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")

    def after(stage, frame=docs):
        return sorted((r.source for r in stage(spark, frame, SF).collect()))

    exact = after(p.drop_exact_copies)
    assert exact == ["b", "c", "g", "h", "i", "j"]
    assert after(p.drop_near_copies, docs.where(F.col("source").isin(exact))) == ["b", "c", "g", "h", "i"]
    assert after(p.drop_near_copies) == ["b", "c", "e", "g", "i"]
    assert after(p.drop_near_copies, docs.where("source in ('a', 'h', 'g')")) == ["g", "h"]

    model, real = toxicity.ConvModel(), p.toxicity.score
    model.constant = 0.0
    toxic = F.col("text_sha256") == hashlib.sha256(BASE.encode()).hexdigest()
    monkeypatch.setattr(p.toxicity, "train", lambda *_: model)
    monkeypatch.setattr(p.toxicity, "score", lambda *a: real(*a).withColumn("predicted", toxic.cast("int")))
    assert after(p.drop_toxic) == ["b", "c", "d", "g", "i", "j"]
    monkeypatch.setattr(p, "table", lambda *_: spark.createDataFrame([(1, BASE)], "item_id long, text string"))
    assert after(p.drop_contaminated) == ["b", "c", "d", "g", "i", "j"]


def test_pipeline_shuffles_texts_by_one_plan_at_every_size(spark):
    """Rows and decisions meet by sort and merge, also where the decisions are few."""
    import corpus_pipeline as p

    docs = spark.createDataFrame([(1, BASE, 1.5), (2, "x", None), (3, "x", None)], "doc_id long, text string, `a b` double")
    for stage in (p.drop_toxic, p.drop_exact_copies, p.drop_near_copies, p.drop_contaminated):
        out = stage(spark, docs, SF)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert out.columns == docs.columns


def test_pipeline(spark, docs, empty):
    import corpus_pipeline as p

    for frame in (docs, empty):
        for name, stage in p.STAGES[:-1]:
            out = stage(spark, frame, SF)
            assert out.columns == frame.columns, name
    kept = {name: sorted(r.doc_id for r in stage(spark, docs.where("doc_id is not null"), SF).collect()) for name, stage in p.STAGES[1:4]}
    assert kept["exact_dedup"] == sorted([2, 5, 4, 6, 7, 8, 8, 9, 10, 11, 12, 13, 14])
    assert {1, 2, 10} & set(kept["simhash_near_dedup"]) == {1} and 6 in kept["simhash_near_dedup"]
    assert p.pack_sequences(spark, empty, SF).count() == 0
