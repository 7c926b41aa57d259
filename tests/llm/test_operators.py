"""Every document operator against a brute-force version, on a fixture with the awkward cases, and on an empty table."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.llm import maxent, minhash, mixing, packing, preference, sharding, suffixes, toxicity

from ..conftest import canonical
from .helpers import DOCS, documents, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark)


def test_sharding(spark, docs):
    df, rows = docs
    got = sharding.shard_rows(df).collect()
    assert len(got) == len(rows)
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    body = {r[0]: (r[1] or "").encode() for r in rows}
    assert all(r["size"] == len(body[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(body[r["doc_id"]]) for r in got)
    assert sharding.shard_rows(empty(spark)).count() == 0


def test_sharding_moves_little():
    counts = {c * sharding.NODES: 5 for c in range(sharding.CELLS)}
    before, after = (sharding.place(counts, n, 64) for n in (8, 9))
    owner = lambda placed: {(c, first + k): s for c, first, n, s, _ in placed for k in range(n)}
    a, b = owner(before), owner(after)
    assert len(a) == len(b) == 5 * sharding.CELLS
    assert sum(a[k] != b[k] for k in a) < len(a) / 2


def test_sharding_against_every_key_on_its_own(spark):
    """Rounds over single keys in ring order, without cells; and every hot id in salts."""
    rows = [(i, f"text {i % 7}", "en", "s", 1) for i in range(700)]
    got = {r["doc_id"]: r["shard"] for r in sharding.shard_rows(spark.createDataFrame(rows, DOCS), virtual_nodes=5, cells=16).collect()}
    points = sharding.ring(8, 5)
    keys = sorted((int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16), i) for i, *_ in rows)
    room, left, want = {s: 700 // 8 + (s < 700 % 8) for s in range(8)}, dict((i, at) for at, i in keys), {}
    for turn in range(8):
        for at, i in keys:
            shard = sharding.clockwise(points, at, 8)[turn]
            if i in left and room[shard]:
                want[i], room[shard] = shard, room[shard] - 1
                left.pop(i)
    assert got == want
    hot = spark.createDataFrame([(None if i % 2 else 5, f"text {i}", "en", "s", 1) for i in range(300)], DOCS)
    placed = sharding.shard_rows(hot, group_rows=20).collect()
    assert len(placed) == 300
    for shard in range(8):
        slots = sorted(r["slot"] for r in placed if r["shard"] == shard)
        assert slots == list(range(len(slots))) and len(slots) in (37, 38)


def test_wide_names_of_windows_change_nothing(spark, docs):
    df, _ = docs
    plain, wide = (sorted(map(tuple, suffixes.remove_repeats(df, wide=w).collect())) for w in (False, True))
    assert plain == wide


def test_suffixes(spark, docs):
    df, rows = docs
    got = sorted(map(tuple, suffixes.remove_repeats(df).collect()))
    starts = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            w = b[k : k + 50]
            starts[w] = min(starts.get(w, i), i)
    want = []
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if starts[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        want.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    assert got == sorted(want) and sum(r[2] for r in want) > 0
    assert suffixes.remove_repeats(empty(spark)).count() == 0


def test_packing(spark, docs):
    df, rows = docs
    got = packing.pack(df, with_ids=True).collect()
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    for i, t, *_ in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), 2048):
            want[i, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    for _, group in itertools.groupby(sorted(got, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in group:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert packing.pack(empty(spark)).count() == 0


def test_tokenizer_shortcuts_are_tried_before_they_are_taken(tmp_path):
    from tokenizers import Tokenizer as Whole
    from tokenizers import models, normalizers, pre_tokenizers

    tok = packing.Tokenizer(packing.tokenizer_path())
    assert tok.by_word and tok.by_part
    words = {w: k for k, w in enumerate(["a", "b", "A", " ", "a b", "[UNK]", *map(chr, range(0x21, 0x7F))])}
    other = Whole(models.BPE(vocab=words, merges=[], unk_token="[UNK]"))
    other.normalizer, other.pre_tokenizer = normalizers.Replace(" ", "A"), pre_tokenizers.Split("", "isolated")
    other.save(str(tmp_path / "t.json"))
    mine = packing.Tokenizer(str(tmp_path / "t.json"))
    for text in ("a b", "Hello, world.", "", "Élan vital"):
        assert mine.ids(text).tolist() == other.encode(text, add_special_tokens=False).ids
    assert not mine.by_word


def test_best_fit_is_best_fit_decreasing():
    rng = np.random.default_rng(0)
    for _ in range(20):
        sizes = sorted(rng.integers(1, 65, 200).tolist(), reverse=True)
        gaps = []
        for s in sizes:
            fit = [g for g in gaps if g >= s]
            if fit:
                gaps.remove(min(fit))
                gaps.append(min(fit) - s)
            else:
                gaps.append(64 - s)
        placed = packing.best_fit(Counter(sizes), 64)
        opened = 1 + max(first + (n - 1) // places for _, _, n, first, _, places in placed)
        assert opened == len(gaps) and sum(p[2] for p in placed) == 200


def test_tokenizer_is_the_tokenizer():
    tok = packing.Tokenizer(packing.tokenizer_path(), remembered=5)
    for t in ("don't I'LL a'b", "x<|endoftext|>y z", "Straße ÀÉ, né.", "İstanbul ΣΑΣ ﬁ", "é x", "12,5 $a1", "日本 。", "a\x1cb\x85c\xa0d", "", "  ", "a b c d e f g h i j k l"):
        assert tok.ids(t).tolist() == tok.loaded.encode(t, add_special_tokens=False).ids


def test_maxent(spark, docs):
    df, rows = docs
    learn = F.crc32(F.coalesce(df["doc_id"].cast("string"), F.lit("")).cast("binary")) % 5 != 1
    got = maxent.score_texts(df, learn).collect()
    tokens = [[*WORD.findall(lower(t)), "\0"] for _, t, *_ in rows]
    trains = [zlib.crc32(str(r[0]).encode()) % 5 != 1 for r in rows]
    c = Counter(w for t, ok in zip(tokens, trains) if ok for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((r[0], not ok, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6)) for r, t, ok in zip(rows, tokens, trains))
    assert sorted((*list(r)[:5], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    none = empty(spark)
    assert maxent.score_texts(none, F.lit(True)).count() == 0


def test_maxent_sums_to_one():
    weights = np.random.default_rng(1).normal(size=((1 << 12) + 1, maxent.CLASSES)).astype(np.float32)
    f = np.random.default_rng(2).integers(0, 1 << 12, (7, 4))
    assert np.allclose(np.exp(maxent.class_logits(weights, f)).sum(1), 1, atol=1e-5)


def test_minhash(spark, docs):
    df, rows = docs
    got = sorted(map(tuple, minhash.near_duplicates(df).collect()))
    sets = {}
    for i, t, *_ in rows:
        w = WORD.findall(lower(t))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == sorted((i, len(sets[i]), find(i), find(i) == i) for i, *_ in rows)
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_densified_sketches_agree_for_equal_sets():
    s = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 3, dtype=np.uint64))
    a, b = minhash.sketch([s, s.copy()])
    assert (a == b).all() and (a != 0xFFFFFFFF).all()


def test_mixing(spark, docs, tmp_path):
    import duckdb

    df, rows = docs
    got = mixing.plan_mix(df, ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken", "position").toPandas()
    frame = df.select(*[c.split()[0] for c in DOCS.split(", ")]).toPandas()
    frame["doc_id"] = frame["doc_id"].astype("int64")
    c = duckdb.connect()
    c.register("documents", frame)
    assert canonical(got) == canonical(c.sql(mixing.SQL).df())
    assert (got.taken <= 3 * got["size"]).all()
    again = mixing.plan_mix(df.repartition(3), ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken", "position").toPandas()
    assert canonical(got) == canonical(again)
    assert mixing.plan_mix(empty(spark), ["doc_id"]).count() == 0
    assert mixing.mixed_documents(empty(spark)).count() == 0


def test_preference(spark):
    import duckdb

    turns = [(0, 0, "user", "hi"), (0, 1, "assistant", "A"), (0, 2, "user", "go"), (0, 3, "assistant", "long é😀"), (1, 0, "user", "hi"), (1, 1, "assistant", "A"), (1, 2, "user", "go"), (1, 3, "assistant", ""),
             (2, 0, None, None), (2, 0, None, None), (3, 0, "user", "x"), (4, 0, "user", "alone"), (6, None, "assistant", "same"), (7, None, "assistant", "same"), (None, 0, "user", "lost"), (-1, 0, "assistant", "neg")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS pair_id", "'x' AS a")
    c = duckdb.connect()
    c.register("conversations", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    got = preference.format_pairs(df)
    assert canonical(got.toPandas()) == canonical(c.sql(preference.SQL).df())
    first = got.where("pair_id = 0").first()
    assert first["prompt_turns"] == 3 and first["prompt"].count("<|user|>") == 2
    at, end = map(int, first["chosen_spans"].split("-"))
    assert first["chosen"][at:end] == "long é😀<|end|>\n"
    assert preference.format_pairs(df.where("false")).count() == 0


def test_preference_of_very_long_texts_and_many_turns(spark):
    long = "é long turn " * 60_000
    turns = [(c, k, "user" if k % 2 == 0 else "assistant", f"turn {k}" if k < 400 else long + str(c)) for c in (0, 1) for k in range(401)] + [(2, 0, "user", long), (3, 0, "user", long)]
    got = {r["pair_id"]: r for r in preference.format_pairs(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()}
    pair = got[0]
    assert pair["prompt_turns"] == 400 and pair["chosen"].count(long) == pair["rejected"].count(long) == 1
    assert long + "0" in pair["chosen"] and long + "1" in pair["rejected"] and long not in pair["prompt"]


def test_toxicity(spark):
    rows, labels = [], []
    for i in range(400):
        bad = i % 5 == 2
        words = [f"w{(i * 7 + k) % 40}" for k in range(20)] + (["vile", "foul"] if bad else [])
        rows.append((i, " ".join(words), "en", "s", 1))
        if i % 2 == 0:
            labels.append((i, 1, int(bad)))
    rows += [(900, None, None, None, None), (901, "", "en", "s", 0), (902, "vile and foul words", "en", "s", 1), (902, "vile and foul words", "en", "s", 1)]
    labels += [(0, 1, None), (2, 1, 1), (None, 1, 1)]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' AS score", "1 AS vote", "2 AS toxic")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(df, lab).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) == (r["doc_id"] % 5 == 2) for r in got if r["doc_id"] < 900)
    assert {r["predicted"] for r in got if r["doc_id"] == 902} == {1}
    assert all(r["score"] == 0 for r in toxicity.score_documents(df, lab.where("false")).collect())
    assert toxicity.score_documents(empty(spark), lab).count() == 0


def test_toxicity_against_brute_force(spark):
    """Scores again in plain Python: terms, document frequencies, evidence, cosines, votes and their calibration."""
    rng = np.random.default_rng(4)
    words = np.array([f"w{k}" for k in range(60)])
    rows = [(i, " ".join(rng.choice(words, 12)) + (" vile" if i % 3 == 0 and i % 7 else ""), "en", "s", 1) for i in range(300)]
    rows += [(300, "vile " * 4000 + "w1", "en", "s", 1), (301, rows[3][1], "en", "s", 1), (302, rows[3][1], "en", "s", 1), (303, "unknown", "en", "s", 1), (304, None, "en", "s", 1)]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(304)]
    df, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    table = toxicity.labelled(df, lab, toxicity.EXAMPLES, toxicity.CALIBRATING, toxicity.SAMPLE_BYTES).to_pylist()
    text = {r[0]: (r[1] or "").split() for r in rows}
    examples, proofs = ([(r["doc_id"], r["toxic"]) for r in table if r["calibrates"] == c] for c in (False, True))
    known = {w for i, _ in examples for w in text[i]}
    share = sum(t for _, t in examples) / len(examples)

    def weight(w):
        df_ = sum(w in set(t) for t in text.values())
        n, hot = (sum(w in set(text[i]) for i, t in examples if t >= least) for least in (0, 1))
        odds = math.log((hot + 10 * share) / (n - hot + 10 * (1 - share))) - math.log(share / (1 - share))
        return (math.log((len(rows) + 1) / (df_ + 1)) + 1) * odds**2

    weights = {w: weight(w) for w in known}

    def vector(i):
        v = {w: (1 + math.log(text[i].count(w))) * weights[w] for w in set(text[i]) & known}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    vectors = {i: vector(i) for i in text}

    def vote(i):
        near = sorted(((-sum(x * vectors[e].get(w, 0) for w, x in vectors[i].items()), e, t) for e, t in examples))
        near = [(c, e, t) for c, e, t in near if c < -1e-12]
        last = near[min(16, len(near)) - 1][0] if near else 0
        sure = [(c, e, t) for c, e, t in near if c < last - 1e-9]
        tied = sorted((e, t, c) for c, e, t in near if abs(c - last) <= 1e-9)[: 16 - len(sure)]
        chosen = sure + [(c, e, t) for e, t, c in tied]
        w = [1 / (1.05 - min(-c, 1)) for c, _, _ in chosen]
        return sum(a * t for a, (_, _, t) in zip(w, chosen)) / sum(w) if chosen else -1.0

    knots = toxicity.isotonic(np.array([vote(i) for i, _ in proofs if vote(i) >= 0]), np.array([t for i, t in proofs if vote(i) >= 0], float))
    x, p = zip(*knots)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(df, lab).collect()}
    assert list(x) == sorted(x) and list(p) == sorted(p)
    silent = [t for i, t in proofs if vote(i) < 0]
    for i in text:
        v = vote(i)
        want = np.interp(v, x, p) if v >= 0 else (sum(silent) + 0.05) / (len(silent) + 1)
        assert abs(got[i] - want) < 1e-6, (i, v)
    assert got[3] == got[301] == got[302]


def test_block_max_search_is_exact_and_leaves_postings_unread():
    rng = np.random.default_rng(0)
    group = np.repeat(np.arange(20), 40)
    rows = [(t := np.unique(np.r_[rng.integers(0, 1000, 30), 1000 + 30 * g + rng.integers(0, 30, 8)]), rng.integers(1, 4, len(t)).astype(float)) for g in group]
    index = toxicity.BlockMaxIndex(rows, np.r_[np.full(1000, 0.1), np.full(600, 2.0)], np.zeros(800), np.arange(800))
    dense = np.zeros((800, 1600))
    for i, k in enumerate(index.ids):
        t, w = index.vector(*rows[k])
        dense[i, t] = w
    rare = dense[:, index.column < 0] > 0
    read = whole = 0
    for (t, n), (cos, which, touched) in zip(rows[::8], index.nearest(rows[::8], 16)):
        q = np.zeros(1600)
        q[t] = index.vector(t, n)[1]
        best = np.sort(dense @ q)[::-1][:16]
        assert np.allclose(cos, best[best > 1e-12])
        read, whole = read + touched, whole + rare[:, q[index.column < 0] > 0].sum()
    assert read < whole / 2
