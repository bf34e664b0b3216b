"""op11 to op13 on small tables against brute force: nulls, empty and long texts, ties, repeated rows, clashing names."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from merkmal.llm import codes, divergence, private

WORDS = ["alpha", "beta", "gamma", "delta", "Epsilon", "zeta", "eta", "theta", "iota", "kappa", "été", "über"]


# ---------------------------------------------------------------- op11


def brute_divergence(rows, k=10):
    docs = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))) for lang, source, text in rows]
    out = []
    for lang in sorted({d[0] for d in docs}):
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t, n in df.items() if n >= 10)
        v = len(kept)
        lang_count = Counter(t for d in mine for t in d[2] if t in df and df[t] >= 10)
        n_lang = sum(lang_count.values())
        sources = sorted({d[1] for d in mine})
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2] if df[t] >= 10) for s in sources}

        def p(c, n):
            return 1 + (10**9 * (c + 2)) // (n + 2 * v)

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            n_s = sum(counts[s].values())
            pair = []
            for o in sources:
                if o != s:
                    n_o = sum(counts[o].values())
                    pair.append((o, sum(f(p(counts[s][t], n_s), p(counts[o][t], n_o)) for t in kept) if v else 0))
            pair.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, s, "pair", o, val, i + 1) for i, (o, val) in enumerate(pair)]
            terms = [(t, f(p(counts[s][t], n_s), p(lang_count[t], n_lang))) for t in kept if counts[s][t] > 0 and p(counts[s][t], n_s) > p(lang_count[t], n_lang)]
            terms.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, s, "term", t, val, i + 1) for i, (t, val) in enumerate(terms[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def corpus_rows():
    rng = random.Random(3)
    rows = []
    for i in range(90):
        lang = rng.choice(["en", "de", None])
        source = rng.choice(["a", "b", "c", "ü", None])
        n = rng.choice([0, 1, 5, 30])
        words = [rng.choice(WORDS[: 4 + i % 8]) for _ in range(n)]
        rows.append((lang, source, " ".join(words) + rng.choice(["", " 42 ", "-x"]) if n or i % 3 else None))
    rows += [("en", "solo", None), ("xx", "only", "alpha beta")] + [rows[5]] * 3
    return rows


def test_divergence_equals_brute_force(spark, corpus_rows):
    frame = spark.createDataFrame([(l, s, t, 1, "x") for l, s, t in corpus_rows], "lang string, source string, text string, count long, term string")
    got = sorted(tuple(r) for r in divergence.divergence(frame).collect())
    assert got == brute_divergence(corpus_rows)
    assert any(r[2] == "term" for r in got) and any(r[2] == "pair" for r in got)


def test_divergence_skyband_cells_change_nothing(spark, corpus_rows):
    frame = spark.createDataFrame(corpus_rows, "lang string, source string, text string")
    groups, kept, held = divergence.counted(frame)
    _, cells = divergence.scored(groups, kept, held)
    one = sorted(tuple(r) for r in divergence.top_terms(cells, 3, cell_terms=10**6).collect())
    many = sorted(tuple(r) for r in divergence.top_terms(cells, 3, cell_terms=1).collect())
    assert one == many


def test_local_skyband_keeps_every_possible_winner():
    import pandas as pd

    rng = np.random.default_rng(1)
    frame = pd.DataFrame({
        "term": [f"t{i:03d}" for i in range(300)],
        "count": rng.integers(1, 20, 300), "lang_count": rng.integers(1, 20, 300),
    })
    band = divergence.local_skyband(frame, 4)
    for i, row in frame.iterrows():
        dominators = ((frame["count"] >= row["count"]) & (frame["lang_count"] <= row["lang_count"]) & (frame["term"] < row["term"])).sum()
        assert (row["term"] in set(band["term"])) == (dominators < 4)


def test_divergence_of_empty_table(spark):
    frame = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.divergence(frame).count() == 0


# ---------------------------------------------------------------- op12


def brute_codes(rows, entries=256, rounds=4):
    good = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ints = {n: [int(np.floor(np.float64(np.float32(x)) * 1024)) for x in v] for n, (i, v, l) in enumerate(good)}
    order = sorted(range(len(good)), key=lambda n: (good[n][0] is None, good[n][0] or 0, ints[n]))
    w = len(ints[order[0]]) // 4
    book = [[ints[n][p * w : (p + 1) * w] for n in order[:entries]] for p in range(4)]

    def near(p, x):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book[p]]
        return min(range(len(d)), key=lambda j: (d[j], j)), min(d)

    for _ in range(rounds):
        new = [list(map(list, b)) for b in book]
        for p in range(4):
            groups = {}
            for n in ints:
                x = ints[n][p * w : (p + 1) * w]
                groups.setdefault(near(p, x)[0], []).append(x)
            for j, xs in groups.items():
                new[p][j] = [sum(c) // len(xs) for c in zip(*xs)]
        book = new
    out = {}
    for n, (i, v, l) in enumerate(good):
        found = [near(p, ints[n][p * w : (p + 1) * w]) for p in range(4)]
        out[n] = (i, l, "".join(f"{j:02x}" for j, _ in found), sum(d for _, d in found))
    per_label = Counter()
    for i, l, c, e in out.values():
        per_label[l] += e
    digest = hashlib.sha256(",".join(str(x) for b in book for e in b for x in e).encode()).hexdigest()
    return [(i, c, e, per_label[l], digest) for i, l, c, e in out.values()]


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(60):
        v = [float(x) for x in rng.normal(0, 0.4, 8).astype(np.float32)]
        rows.append((i if i % 17 else None, v, int(i % 3) if i % 5 else None))
    rows += [(100, None, 1), (101, [1.0, float("nan")] + [0.0] * 6, 1), (102, [None] + [0.0] * 7, 2), (103, [float("inf")] * 8, 0)]
    rows += [rows[3], rows[3]]
    frame = spark.createDataFrame([(i, v, l, "x", 7) for i, v, l in rows], "vec_id long, embedding array<float>, label int, code string, error int")
    got = [(r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in codes.compress(frame, entries=5).collect()]
    want = brute_codes(rows, entries=5)
    assert sorted(got, key=str) == sorted(want, key=str)


def test_bitmask_nearest_equals_full_scan():
    rng = np.random.default_rng(9)
    books = rng.integers(-500, 500, (4, 256, 16))
    books[0, 10] = books[0, 11]  # equal entries: the lower index wins
    book = codes.Codebooks(books)
    x = rng.integers(-700, 700, (3000, 16))
    x[:5] = books[0, 11]
    for p in range(4):
        best, dist = book.nearest(p, x)
        full = ((x[:, None, :] - books[p][None]) ** 2).sum(2)
        assert (dist == full.min(1)).all()
        assert (best == full.argmin(1)).all()


def test_codes_of_empty_and_unusable_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert codes.compress(empty).count() == 0
    bad = spark.createDataFrame([(1, None, 1), (2, [float("nan")], 1)], "vec_id long, embedding array<float>, label int")
    assert codes.compress(bad).count() == 0


# ---------------------------------------------------------------- op13


def test_base_spans_follow_the_patterns():
    text = "mail a.b@x.org, ip 10.0.0.256 and 192.168.1.1, card 4111 1111 1111 1111, bad 4111 1111 1111 1112, call +49 (30) 123-4567 or +1 2."
    spans = private.base_spans(text)
    kinds = [(k, text[a:b]) for k, a, b in spans]
    assert ("email", "a.b@x.org") in kinds
    assert ("ip", "192.168.1.1") in kinds and all(v != "10.0.0.256" for _, v in kinds)
    assert ("card", "4111 1111 1111 1111") in kinds and all("1112" not in v for k, v in kinds if k == "card")
    assert ("phone", "+49 (30) 123-4567") in kinds
    assert private.base_spans(None) == [] and private.base_spans("") == []


def test_private_rows_against_patterns(spark):
    rng = random.Random(2)
    texts = []
    for i in range(300):
        words = [rng.choice(WORDS) for _ in range(rng.randint(0, 40))]
        if i % 3 == 0:
            words.insert(rng.randint(0, len(words)), f"user{i}@mail{i % 7}.example.com")
        if i % 4 == 0:
            words.insert(rng.randint(0, len(words)), f"+49 30 {rng.randint(1000000, 9999999)}")
        if i % 5 == 0:
            words.insert(rng.randint(0, len(words)), f"10.{i % 250}.3.{rng.randint(0, 255)}")
        texts.append(" ".join(words))
    texts += [None, "", "ü" * 5000 + " a@b.cd " + "x" * 200_000]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, texts[0], "clash"), (0, texts[0], "clash")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = private.private_data(frame, rows=200).collect()
    assert len(got) == len(rows)
    for r in got:
        text = texts[r["doc_id"]] if r["doc_id"] is not None else texts[0]
        base = private.base_spans(text)
        assert r["base_sha256"] == hashlib.sha256(private.joined(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in private.KINDS] == [sum(s[0] == k for s in base) for k in private.KINDS]
        assert set(private.joined(base).split(",")) <= set(r["spans"].split(","))


def test_tagger_learns_the_base_spans():
    rng = random.Random(6)

    def sample(i):
        words = [rng.choice(WORDS) for _ in range(rng.randint(3, 12))]
        words.insert(rng.randint(0, len(words)), rng.choice([f"u{i}@ex{i % 5}.org", f"+33 1 {rng.randint(10**6, 10**7 - 1)}"]))
        return " ".join(words)

    train = [w for i in range(300) for w in private.training_windows(sample(i), i)]
    model = private.Tagger()
    losses = model.fit(np.stack([w for w, _ in train]), np.stack([t for _, t in train]), steps=150)
    assert losses[-1] < losses[0] / 3
    held = [sample(1000 + i) for i in range(60)]
    found = private.model_spans(model, held)
    hit = sum(any(k == b[0] and a <= b[1] < e for k, a, e in f) for f, t in zip(found, held) for b in private.base_spans(t))
    assert hit >= 0.9 * sum(len(private.base_spans(t)) for t in held)


def test_window_reconciliation_covers_every_region():
    text = "a" * 100 + "1" * 300 + "b" * 100
    for a, b in private.regions(text):
        starts = private.window_starts(a, b, len(text))
        covered = set()
        for s in starts:
            covered.update(range(s, min(s + private.LENGTH, len(text))))
        assert set(range(a, b)) <= covered


def test_divergence_counts_meet_their_sources_in_one_join(spark, corpus_rows):
    """Counts of the language stand in the counted rows; shares are exact, also where a long can't hold the product."""
    frame = spark.createDataFrame(corpus_rows, "lang string, source string, text string")
    groups, kept, held = divergence.counted(frame)
    _, cells = divergence.scored(groups, kept, held)
    assert cells._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    limit = (2**63 - 1) // divergence.SCALE - 2
    counts = [0, 1, 7, limit - 1, limit, limit + 1, 2**50]
    rows = spark.createDataFrame([(c, 2 * c + 5, 9) for c in counts], "count long, total long, n_kept long")
    got = [r[0] for r in rows.select(divergence.share("count", "total", "n_kept")).collect()]
    assert got == [1 + divergence.SCALE * (c + 2) // (2 * c + 5 + 18) for c in counts]
