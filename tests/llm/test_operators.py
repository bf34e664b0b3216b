"""Operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing column names."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from merkmal.llm import decontaminate, html_text, licenses, near_vectors, packing, sharding, shingle_join, substrings, toxicity, warc
from merkmal.llm.common import lowest_by_hash
from merkmal.session import scratch_path

WORDS = [a + b for a in "bdfklmnprst" for b in ("a", "e", "io", "u")]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    base = [text(rng, n) for n in (0, 1, 3, 5, 12, 13, 40, 60, 200, 3000)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20 + i, base[7]) for i in range(3)]
    words = base[8].split()
    for i in range(12):
        near = list(words)
        for _ in range(i):
            near[rng.randrange(len(near))] = rng.choice(WORDS)
        rows.append((40 + i, " ".join(near)))
    rows += [(60, base[6] + " " + text(rng, 30)), (61, text(rng, 20) + " " + base[6]), (None, base[8]), (None, None), (70, None), (71, "  \n")]
    rows.append(rows[-1])
    return rows


@pytest.fixture(scope="module")
def frame(spark, docs):
    rows = [(i, t, "x", 1, 2) for i, t in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, home string, bucket int, slot int")


def empty(frame):
    return frame.filter("doc_id = -1")


def test_shards_hold_all_rows_gapless_and_near_equal(frame, docs):
    rows = sharding.with_slots(frame)
    sizes = sharding.slot_sizes(rows)
    out = sharding.shard(rows, sizes, sharding.assigned(sizes, 4)).collect()
    assert len(out) == len(docs)
    for s, group in itertools.groupby(sorted(out, key=lambda r: r["shard"]), key=lambda r: r["shard"]):
        assert sorted(r["slot"] for r in group) == list(range(sum(r["shard"] == s for r in out)))
    got = sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=str)
    assert got == sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs), key=str)
    loads = [sum(r["size"] for r in out if r["shard"] == s) for s in range(4)]
    largest_slot = max(r["bytes"] for r in sizes.collect())
    assert max(loads) - min(loads) <= largest_slot  # each slot went to the lightest shard of its time
    assert sharding.with_slots(empty(frame)).count() == 0


def test_rebalanced_map_moves_no_more_than_needed(spark):
    sizes = spark.createDataFrame([(i, 10 + i % 3, 1) for i in range(64)], "virtual_slot int, bytes long, n_rows long")
    old = sharding.assigned(sizes, 4)
    root = scratch_path(spark, "map")
    sharding.save_map(old, root, 1)
    new = {r["virtual_slot"]: r["shard"] for r in sharding.rebalanced(sharding.load_map(spark, root, 1), sizes, 5).collect()}
    before = {r["virtual_slot"]: r["shard"] for r in old.collect()}
    moved = [k for k in before if before[k] != new[k]]
    assert len(new) == 64 and 0 < len(moved) <= 20


def test_boundaries_have_least_padding():
    rng = random.Random(1)
    for _ in range(20):
        lengths = sorted(rng.sample(range(1, 40), 7))
        counts = [rng.randint(1, 9) for _ in lengths]
        tokens = [n * c for n, c in zip(lengths, counts)]

        def cost(bounds):
            return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))

        best = min(cost(set(c) | {lengths[-1]}) for c in itertools.combinations(lengths, 2))  # two and the longest
        assert cost(packing.best_boundaries(lengths, counts, tokens, 3)) <= best


def test_long_lengths_have_least_padding_too(spark):
    rng = random.Random(2)
    for size, buckets in [(1, 4), (3, 16), (60, 5), (200, 16)]:
        lengths = sorted(rng.sample(range(1, 20_000), size))
        counts = [rng.randint(1, 50) for _ in lengths]
        least = {0: 0}  # of the lengths before, by their number
        for _ in range(buckets):
            least = {j: min(p + sum((lengths[j - 1] - lengths[m]) * counts[m] for m in range(i, j)) for i, p in least.items() if i <= j) if j else 0
                     for j in range(size + 1)} if size < 100 else {}
        bounds = packing.best_boundaries(lengths, counts, [n * c for n, c in zip(lengths, counts)], buckets)
        assert len(bounds) <= buckets and bounds[-1] == lengths[-1]
        if least:
            assert sum((min(b for b in bounds if b >= n) - n) * c for n, c in zip(lengths, counts)) == least[size]
    rows = spark.range(40).select(F.when(F.col("id") < 30, 1001).otherwise(F.col("id") + 5000).cast("long").alias("n"), F.col("id").alias("doc_id"))
    out = packing.pack(rows, F.col("n"), ["doc_id"], buckets=11).collect()
    assert len(out) == 40 and all(r["padding"] == 0 and r["bucket_tokens"] == r["n"] for r in out)


def test_batches_keep_the_budget(frame, docs):
    out = packing.pack(packing.with_token_count(frame, "_n"), F.col("_n"), ["doc_id", "text"], buckets=3, budget=300, cells=4).collect()
    assert len(out) == len(docs)
    for _, rows in itertools.groupby(sorted(out, key=lambda r: (r["bucket"], r["batch"])), key=lambda r: (r["bucket"], r["batch"])):
        rows = list(rows)
        assert len({r["slot"] for r in rows}) == len(rows)
        assert len(rows) == 1 or len(rows) * rows[0]["bucket_tokens"] <= 300
        assert all(r["n_tokens"] == len((r["text"] or "").split()) <= r["bucket_tokens"] for r in rows)
    assert packing.pack(packing.with_token_count(empty(frame), "_n"), F.col("_n"), ["doc_id"]).count() == 0


def test_substrings_against_brute_force(frame, docs):
    windows = lambda w: [tuple(w[s : s + 13]) for s in range(len(w) - 12)]
    first = {}
    for i, t in docs:
        for w in windows((t or "").split()) if i is not None else []:
            first[w] = min(i, first.get(w, i))
    expected = []
    for i, t in docs:
        words = (t or "").split()
        gone = {s + k for s, w in enumerate(windows(words)) if i is not None and first[w] < i for k in range(13)}
        kept = " ".join(w for p, w in enumerate(words) if p not in gone)
        expected.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    out = [tuple(r) for r in substrings.without_repeats(frame, ["doc_id"], digest=True).collect()]
    assert sorted(out, key=str) == sorted(expected, key=str)
    assert substrings.without_repeats(empty(frame), ["doc_id"]).count() == 0


def test_shingle_join_against_brute_force(frame, docs):
    sets, low = [], {}
    for i, t in docs:
        w = (t or "").lower().split()
        sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    known = [(i, s) for i, s in sets if i is not None]
    low = {i: i for i, _ in known}
    for _ in known:
        for (a, x), (b, y) in itertools.combinations(known, 2):
            if x and 100 * len(x & y) >= 75 * len(x | y):
                low[a] = low[b] = min(low[a], low[b])
    out = shingle_join.linked_components(frame).filter("doc_id is not null").collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in out} == {(i, len(s), low[i]) for i, s in known}
    assert shingle_join.linked_components(empty(frame)).count() == 0


def test_contamination_against_brute_force(spark, frame, docs):
    items = [(1, " ".join(docs[8][1].split()[20:45])), (2, " ".join(docs[8][1].split()[20:45])), (10, docs[9][1][:300]), (3, docs[2][1].upper()),
             (4, None), (5, "..."), (None, docs[7][1])]
    windows = {}
    for item, t in items:
        w = (t or "").lower().replace(".", " ").split()
        for s in range(len(w) - min(10, len(w)) + 1) if w else []:
            windows.setdefault(tuple(w[s : s + 10]), set()).add(item)
    expected = []
    for i, t in docs:
        w, hit, found = (t or "").split(), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        ids = sorted(str(x) for x in found if x is not None)
        expected.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    table = spark.createDataFrame(items, "item_id long, text string")
    out = [tuple(r) for r in decontaminate.contamination(frame, table).collect()]
    assert sorted(out, key=str) == sorted(expected, key=str)
    assert decontaminate.contamination(frame, table.filter("item_id = -1")).filter("contaminated").count() == 0


def test_licences(spark):
    rows = [(1, "Released under the MIT License."), (2, "GNU General Public  License; mit license mit license"), (3, None), (4, "licensed under CC BY-NC 4.0."),
            (5, "license of the mit"), (5, "license of the mit")]
    out = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (out[1]["base_labels"], out[1]["first_word"]) == ("mit", 3)
    assert (out[2]["n_base"], out[2]["first_word"], out[2]["last_word"], out[2]["base_labels"]) == (3, 1, 6, "gpl,mit")
    assert (out[3]["n_words"], out[3]["labels"], out[3]["first_word"]) == (0, "", None)
    assert out[4]["labels"] == "cc-by-nc" and out[5]["labels"] == ""


def test_licences_of_many_notices_in_one_file(spark):
    of = {label: words for label, words, _ in licenses.TEMPLATES}
    groups = [["bsd", "all-rights-reserved"], ["mit-text", "all-rights-reserved"], ["mit-text", "bsd", "mpl"], ["cc-by", "all-rights-reserved"],
              ["mit-text", "bsd", "gpl", "mpl", "lgpl", "apache", "cc-by", "cc0"], list(of)]
    rows = [(i, " filler words here ".join(of[label] for label in group)) for i, group in enumerate(groups)]
    rows.append((len(groups), "all rights reserved all " * 3000 + of["mpl"]))
    out = {r["doc_id"]: set(r["labels"].split(",")) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {**{i: set(group) for i, group in enumerate(groups)}, len(groups): {"all-rights-reserved", "mpl"}}


def test_warc_round_trip(spark):
    big = "ü" * 600
    rows = [(1, "http://a/", big), (2, "http://b/\n", big), (3, None, "x"), (4, "http://c/", "x"), (None, "http://d/", big), (6, "u", None), (6, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    names = []
    for _ in range(2):
        root = scratch_path(spark, "warc-test")
        manifest = warc.write_warc(pages, root, roll_bytes=300)
        names.append(sorted(tuple(r) for r in manifest.collect()))
        out = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.read_warc(manifest, root).collect()), key=str)
    assert names[0] == names[1]
    assert out == sorted([(1, 1200, "revisit", 2), (2, 1200, "response", None), (3, 1, "response", None), (4, 1, "response", None),
                          (None, 1200, "revisit", 2), (6, 0, "response", None), (6, 0, "response", None)], key=str)


def test_main_text(spark):
    model = html_text.fit(html_text.PAGES)
    page = ('<html><head><title>t</title><script>x("</p>")</script></head><body><nav><a href="/">Menu</a></nav><div class="ad">Buy</div>'
            "<article><h1>Head &amp; more</h1><p>One <b>bo</b>ld\n text<br>two<p>Three &lt;3</article><footer>&copy; foot</footer>")
    table = spark.createDataFrame([(1, "u", page), (2, None, None), (3, "v", "")], "page_id long, url string, html string")
    out = {r["page_id"]: r["text"] for r in html_text.extract(table, model).collect()}
    assert out == {1: "Head & more One bold text two Three <3", 2: "", 3: ""}


def test_vectors_against_brute_force(spark):
    rng = random.Random(3)
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(40)]
    rows = [(i, v) for i, v in enumerate(base)] + [(100 + i, [x + rng.gauss(0, 0.15) for x in base[i % 9]]) for i in range(40)]
    bad = [(300, None), (301, [0.0] * 8), (302, [float("nan")] * 8), (303, [None] * 8), (304, [1.0, 2.0]), (305, [float("inf")] * 8)]

    def cosine(x, y):
        return sum(a * b for a, b in zip(x, y)) / (sum(a * a for a in x) * sum(b * b for b in y)) ** 0.5

    links, low = {i: 0 for i, _ in rows + bad}, {i: i for i, _ in rows + bad}
    near = [(a, b) for (a, x), (b, y) in itertools.combinations(rows, 2) if cosine(x, y) >= 0.9]
    for a, b in near:
        links[a] += 1
        links[b] += 1
    for _ in rows:
        for a, b in near:
            low[a] = low[b] = min(low[a], low[b])
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    out = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_vectors.near_vectors(table).collect()}
    assert out == {(i, links[i], low[i], low[i] == i) for i in low}


def test_disguised_words_are_restored():
    rng = random.Random(4)
    plain = " ".join(rng.choice(["you", "are", "an", "idiot", "loser", "the", "clown", "stupid", "good", "cool"]) for _ in range(4000))
    words = toxicity.Words(toxicity.letter_counts(plain).astype("float32"))
    for token, word in [("1d10t", "idiot"), ("l0$er", "loser"), ("stuuuupid", "stupid"), ("i.d.i.o.t", "idiot"), ("cl0wn,", "clown")]:
        assert word in words[token], token
    assert "idiot" in toxicity.restored("an i d i o t here", words)


def test_gaps_signs_and_short_runs_are_part_of_the_search():
    rng = random.Random(4)
    plain = " ".join(rng.choice(["you", "are", "a", "an", "idiot", "moron", "the", "clown", "stupid", "good", "cool", "go"]) for _ in range(4000))
    words = toxicity.Words(toxicity.letter_counts(plain).astype("float32"))
    cases = [("s t u p i d.", "stupid"), ("i d i o t, go", "idiot"), ("a s t u p i d", "stupid"), ("i d i o t s t u p i d", "idiot stupid"),
             ("a $ t u p i d", "stupid"), ("s t u p ! d", "stupid"), ("(s t u p i d !)", "stupid"), ("s t u u p i d", "stupid"), ("stuupid", "stupid"),
             ("iidiot", "idiot"), ("id!ot,moron", "idiot moron"), ("you-$tupid", "you stupid"), ("st-upid", "stupid"), ("good", "good")]
    for line, expected in cases:
        assert set(expected.split()) <= toxicity.restored(line, words), line
    assert words.decoder.decode("you.are,a-m0ron") == "you are a moron"


def test_toxic_words_are_learned_from_the_training_fold(spark):
    rng = random.Random(6)
    rows = [(i, text(rng, 30) + (" vile" + rng.choice(WORDS) if i % 3 == 0 else "")) for i in range(300)] + [(900, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(300)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == 302 and all(0 <= r["score"] <= 1 for r in out)
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 300]
    assert held and all(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in held)


def test_hash_sample_is_that_of_a_plain_sort(spark):
    table = spark.range(30_000).withColumn("x", F.col("id") % 7)
    got = {r["id"] for r in lowest_by_hash(table, ["id"], 200, 30_000).collect()}
    plain = sorted((r["h"], r["id"]) for r in table.select("id", F.xxhash64("id").alias("h")).collect())[:200]
    assert got == {i for _, i in plain}
    assert lowest_by_hash(table, ["id"], 40_000, 30_000).count() == 30_000
    assert lowest_by_hash(table.filter("false"), ["id"], 5, 0).count() == 0
    few = lowest_by_hash(table.select("x"), ["x"], 50, 30_000)  # repeated keys pass together or not at all
    assert few.count() <= 50


def test_scores_decode_only_words_that_can_be_evidence(monkeypatch):
    """A scorer that skips hopeless words gives the scores of one that decodes every disguised word."""
    import math
    import random

    import pyarrow as pa

    from merkmal.llm import toxicity as T

    plain = "the committee of all good friends will meet soon and needless hate is bad " * 40
    model = T.letter_counts(plain).astype("float32")
    lexicon = {"hate": 3.0, "needless": 2.0, "good": 1.7, "need-": 1.6, "bad": 2.5, "frien-": 1.5}

    class Handle:
        value = (model, lexicon)

    draw = random.Random(7)
    swap = {"a": "a4@", "e": "e3", "o": "o0", "i": "i1!", "s": "s5$", "t": "t7+"}

    def disguise(word: str) -> str:
        out = "".join(draw.choice(swap.get(ch, ch)) * draw.choice((1, 1, 1, 2, 3)) + draw.choice(("", "", "", "-", ".", "_")) for ch in word)
        return draw.choice((out, out.upper(), "x-" + out, out + "!!"))

    texts = [" ".join(disguise(draw.choice(plain.split())) for _ in range(12)) for _ in range(150)] + ["h a t e", "b.a.d", "", "committee all soon"]
    words = T.Words(model)

    def worth(text: str) -> float:
        return sum({w: best for w in T.restored(text, words) if (best := max(lexicon.get(f, 0.0) for f in T.word_features(w)))}.values())

    expected = [1 / (1 + math.exp(2.0 - worth(t))) for t in texts]
    calls = []
    decode = T.Decoder.decode
    monkeypatch.setattr(T.Decoder, "decode", lambda self, word: calls.append(word) or decode(self, word))
    found = T._scorer(Handle, -2.0)()(pa.array(texts))
    assert max(expected) > 0.9 and all(abs(a - b) < 1e-9 for a, b in zip(found, expected))
    assert calls and not {"committee", "all", "soon"} & set(calls)
    monkeypatch.setattr(T, "KEPT_TOKENS", 3, raising=False)  # a small memory forgets, but scores the same
    assert all(abs(a - b) < 1e-9 for a, b in zip(T._scorer(Handle, -2.0)()(pa.array(texts)), expected))


def test_pairs_that_share_many_entries_are_made_once(spark):
    sketch = {f"k{i}": 0 for i in range(shingle_join.SKETCH)}
    rows = [(e, d, 400, 2, 0.5, d < 8, True, d) for e in range(1, 41) for d in (3, 8, 9)]  # 3 and the others are apart
    rows += [(50, 3, 400, 2, 0.5, True, True, 3), (50, 8, 400, 2, 0.5, False, True, 8), (51, 3, 400, 2, 0.5, True, True, 3)]
    placed = spark.createDataFrame(rows, "entry long, doc long, n long, band int, common double, chose boolean, open boolean, part long")
    kept = shingle_join.telling(placed)
    assert sorted(r["entry"] for r in kept.select("entry").distinct().collect()) == [1, 50]
    for k, v in sketch.items():
        placed, kept = placed.withColumn(k, F.lit(v).cast("long")), kept.withColumn(k, F.lit(v).cast("long"))
    for open_ in (placed, kept):  # with and without the repeated entries
        made = shingle_join.meeting(shingle_join.with_first_entries(open_)).collect()
        assert sorted((r["a"], r["b"]) for r in made) == [(3, 8), (3, 9)]


def test_sets_of_rows_with_equal_ids_hide_no_pair(spark):
    """Id 3 has a set of 400 and one of 100 entries; only the first may link with 8, at entries that the other does not choose."""
    rows = [(1, 3, 100, 1, 0.5, True, True, 3), (7, 3, 400, 2, 0.5, True, True, 3), (1, 8, 400, 2, 0.5, False, True, 8), (7, 8, 400, 2, 0.5, False, True, 8)]
    open_ = spark.createDataFrame(rows, "entry long, doc long, n long, band int, common double, chose boolean, open boolean, part long")
    for i in range(shingle_join.SKETCH):
        open_ = open_.withColumn(f"k{i}", F.lit(0).cast("long"))
    assert [tuple(r) for r in shingle_join.meeting(shingle_join.with_first_entries(open_)).collect()] == [(3, 8)]
