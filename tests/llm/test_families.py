"""Near copies inside a large family of loosely similar documents."""

import random

import numpy as np

from factloom.llm import minhash

from .helpers import DOCS


def family(n_pairs=1000, words=1200, edits=23, common=7):
    """Documents of one template, about 0.70 alike; documents 2k and 2k + 1 share edits and are about 0.76 alike."""
    rng = random.Random(5)
    template = [f"w{i}" for i in range(words)]
    texts = []
    for k in range(n_pairs):
        slots = rng.sample(range(words // 5), 2 * edits - common)
        for side in (slots[:edits], slots[:common] + slots[edits:]):
            text = template[:]
            for at, slot in enumerate(side):
                text[5 * slot + 2] = f"p{k}x{slot}" if at < common else f"d{len(texts)}x{slot}"
            texts.append(" ".join(text))
    return texts


def test_every_link_of_a_template_family(spark):
    texts = family()
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    place = {}
    for s in sets:
        for g in s:
            place.setdefault(g, len(place))
    incidence = np.zeros((len(sets), len(place)), bool)
    for i, s in enumerate(sets):
        incidence[i, [place[g] for g in s]] = True
    often = incidence.sum(0) > 1
    dense = incidence[:, often].astype(np.float32)
    both = (dense @ dense.T).astype(int)
    size = np.array([len(s) for s in sets])
    linked = 100 * both >= 75 * (size[:, None] + size - both)
    assert linked[range(0, len(sets), 2), range(1, len(sets), 2)].mean() > 0.9
    label = np.arange(len(sets))
    while True:
        now = np.where(linked, label, len(sets)).min(1)
        if (now == label).all():
            break
        label = now
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS).repartition(8)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df).collect()}
    assert got == dict(enumerate(label.tolist()))


def test_overlaps_of_blocks():
    rng = np.random.default_rng(3)
    x, y = ([np.unique(rng.integers(0, 5000, 300).astype(np.uint64)) for _ in range(40)] for _ in "xy")
    want = np.array([[len(np.intersect1d(a, b)) for b in y] for a in x])
    for share in (0.05, 1.0):
        pairs = rng.random((40, 40)) < share
        assert (minhash.overlaps(x, y, pairs)[pairs] == want[pairs]).all()


def test_further_bits_of_names_follow_the_input(spark):
    from factloom.llm import suffixes

    assert [suffixes.further_bits(n) for n in (1 << 30, (1 << 33) - 1, 1 << 33, 10**10, 1 << 37, 1 << 38, 1 << 50)] == [0, 0, 8, 8, 8, 16, 64]
    same = "".join(chr(97 + k * k % 23) for k in range(120))
    df = spark.createDataFrame([(k, f"{k} {same} {k}{'x' * k}") for k in range(30)], "doc_id long, text string")
    plain, narrow = (sorted(map(tuple, suffixes.remove_repeats(df, wide=w).collect())) for w in (0, 8))
    assert plain == narrow and sum(r[2] for r in plain) > 0
