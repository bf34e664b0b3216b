"""Toxicity by noisy-channel restoration: decode disguised words under a character model, then score."""

from __future__ import annotations

import math
import re
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from merkmal.llm.common import ALNUM_TABLE, lowest_by_hash, read_table, small_batches

# Letters that a sign can stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "¢": "c",
}
SIGN_COST = 0.7
KEPT_SIGN_COST = 6.0
REPEAT_COST = 0.4
SIGN_BORDER_COST = 3.0

SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
SMOOTHING = 4.0
UNIFORM = 1.0 / 64

TOXIC_ROWS = 4_000
CLEAN_ROWS = 12_000
PREFIXES = (4, 5, 6)
BRANCHES = 4
LEAST_GAIN = 18.0
LEAST_EVIDENCE = 1.5
MOST_EVIDENCE = 8.0
CAUTION = 1.64
THRESHOLD = 0.7
#: Tokens a task remembers the worth of, in each of two generations.
KEPT_TOKENS = 150_000

_MASK = (1 << 32) - 1
_K = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
_SHIFT = 32 - SLOT_BITS
PUNCTUATION = ".,;:!?\"'()[]{}<>…«»“”„’"
RUN = re.compile(r"(.)\1")
#: Three single letters or signs of LEET at least with gaps between them; punctuation may stand around the run.
SPACED = re.compile(
    r"""(?<![^\s"'(\[{<«“„])(?<!\w')(?:[^\W_]|[@$!|+€£¢])(?:[ .\-_*~]{1,3}(?:[^\W_]|[@$!|+€£¢])){2,}(?=[.,;:!?"')\]}>…»”*~_\-]*(?!\S))""")
EDGES = re.compile(r"^[^\w@$!|+€£¢]+|[^\w@$|+€£¢]+$")
GAPS = re.compile(r"[^\w@$!|+€£¢]+|_+")


def _slot(a: int, b: int, c: int) -> int:
    return ((a * _K[0] + b * _K[1] + c * _K[2]) & _MASK) >> _SHIFT


def letter_counts(text: str) -> np.ndarray:
    """Counts of letter triples (first half) and of their contexts (second half) in hashed slots.

    What is no letter counts as a border, which is 0.
    """
    codes = np.frombuffer(("\0\0" + text.lower() + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes * ((codes >= 128) | (codes - np.uint32(97) < 26))
    b, c = codes[1:-1], codes[2:]
    context = codes[:-2] * (b != 0) * np.uint32(_K[0]) + b * np.uint32(_K[1])
    triples = np.bincount((context + c * np.uint32(_K[2])) >> np.uint32(_SHIFT), minlength=SLOTS)
    return np.concatenate([triples, np.bincount(context >> np.uint32(_SHIFT), minlength=SLOTS)])


def letter_model(docs: DataFrame) -> np.ndarray:
    """Letter triples of all texts. Tasks send their own counts, which are summed by slot; the model has a fixed size."""

    def run(batches):
        total, texts, size = np.zeros(2 * SLOTS, np.int64), [], 0
        for batch in small_batches(batches):
            for text in batch.column("text").to_pylist():
                texts.append(text)
                size += len(text or "")
                if size > 1_000_000:
                    total += letter_counts("\0".join(t for t in texts if t))
                    texts, size = [], 0
        total += letter_counts("\0".join(t for t in texts if t))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["slot", "n"])

    lines = docs.select("text").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    table = lines.toArrow()  # at most two lines per slot
    model = np.zeros(2 * SLOTS, np.float32)
    model[table.column("slot").to_numpy()] = table.column("n").to_numpy()
    return model


class Decoder:
    """Viterbi search over the readings of a disguised word."""

    def __init__(self, model: np.ndarray):
        self.triples, self.contexts = model[:SLOTS], model[SLOTS:]
        self.cost = lru_cache(1 << 16)(self.cost)

    def cost(self, a: int, b: int, c: int) -> float:
        """-log P(c | a, b) of the character model, smoothed towards equal letters."""
        if b == 0:
            a = 0
        n = float(self.triples[_slot(a, b, c)]) + SMOOTHING * UNIFORM
        return -math.log(n / max(n, float(self.contexts[_slot(a, b, 0)]) + SMOOTHING))

    def decode(self, word: str) -> str:
        """Likeliest plain reading of ``word`` (lower case), words separated by one space.

        A run of one sign may be read as one, two or all of its repetitions; a
        sign of LEET as one of its letters or, at a price, as itself or (if it is
        no digit) as a border. Any other sign is a gap, which is dropped or kept as
        a border; a letter repeated across a dropped gap may be dropped too. The
        state is the last two letters, (0, 0) after a border, so the search is
        exact for the triple model.
        """
        states = {(0, 0): (0.0, "")}
        before = gap = ""

        def put(following, state, cost, text):
            if state not in following or (cost, text) < following[state]:
                following[state] = (cost, text)

        for sign, group in groupby(word, lambda ch: ch if ch.isalnum() or ch in LEET else " "):
            n = len(list(group))
            following: dict[tuple[int, int], tuple[float, str]] = {}
            if not sign.isalnum():
                price = SIGN_BORDER_COST if sign in LEET else 0.0
                for (a, b), (cost, text) in states.items():
                    put(following, (0, 0), cost + price + (self.cost(a, b, 0) if b else 0.0), text + " ")
            if sign == " ":
                for state, (cost, text) in states.items():
                    put(following, state, cost, text)
                states, gap = following, sign
                continue
            readings = [(c, SIGN_COST) for c in LEET.get(sign, "")] + [(sign, KEPT_SIGN_COST if sign in LEET else 0.0)]
            lengths = sorted({1, min(2, n), n} if n > 1 else {1})
            for (a0, b0), (cost0, text0) in states.items():
                if gap and sign == before and b0:
                    put(following, (a0, b0), cost0 + REPEAT_COST, text0)
                for letter, price in readings:
                    c = ord(letter)
                    for length in lengths:
                        a, b, cost = a0, b0, cost0 + price + (REPEAT_COST if length < n else 0.0)
                        for _ in range(length):
                            cost += self.cost(a, b, c)
                            a, b = b, c
                        put(following, (a, b), cost, text0 + letter * length)
            states, before, gap = following, sign, ""
        return min((cost + (self.cost(a, b, 0) if b else 0.0), text) for (a, b), (cost, text) in states.items())[1].strip()


def disguised(token: str) -> bool:
    """Letters mixed with signs that can stand for letters or with gaps, or with a run of two."""
    letters = sum(ch.isalpha() for ch in token)
    if not letters:
        return False
    if any(ch in LEET for ch in token):
        return True
    return bool(RUN.search(token) or GAPS.search(token))


class Beginnings:
    """First letters of lexicon features: a word that begins otherwise is no evidence, whatever follows."""

    LETTERS = PREFIXES[0]

    def __init__(self, lexicon: dict[str, float]):
        self.whole = {f[: self.LETTERS] for f in lexicon}
        self.parts = {f[:n] for f in lexicon for n in range(1, self.LETTERS)}

    def may_be_read(self, word: str) -> bool:
        """Whether any path of the decoder's lattice holds a word that begins so; the likeliest path is one of them.

        States are the letters of the current word so far, "" after a border; hopeless ones are dropped.
        """
        states, before, gap = {""}, "", ""
        for sign, group in groupby(word, lambda ch: ch if ch.isalnum() or ch in LEET else " "):
            n = len(list(group))
            following = set()
            if not sign.isalnum():
                if not states.isdisjoint(self.whole):
                    return True
                following.add("")
            if sign == " ":
                states, gap = following | states, sign
                continue
            if gap and sign == before:
                following |= states - {""}
            runs = [letter * length for letter in LEET.get(sign, "") + sign for length in {1, min(2, n), n}]
            for state in states:
                for run in runs:
                    letters = (state + run)[: self.LETTERS]
                    if len(letters) < self.LETTERS:
                        if letters in self.parts:
                            following.add(letters)
                    elif letters in self.whole:
                        return True
            states, before, gap = following, sign, ""
        return not states.isdisjoint(self.whole)


class Words(dict):
    """Token as it stands in a text -> tuple of plain words it is read as; bounded memory."""

    def __init__(self, model: np.ndarray, limit: int = 100_000):
        super().__init__()
        self.decoder, self.limit = Decoder(model), limit

    def __missing__(self, token: str) -> tuple[str, ...]:
        if len(self) >= self.limit:
            self.clear()
        value = self[token] = self.read(token)
        return value

    def read(self, token: str, wanted: Beginnings | None = None) -> tuple[str, ...]:
        low = token.lower().strip(PUNCTUATION)
        return (low,) if low.isalpha() and not RUN.search(low) else self._readings(token, wanted)

    def _readings(self, token: str, wanted: Beginnings | None = None) -> tuple[str, ...]:
        """Plain words of a token; of disguised ones only those that may be read as ``wanted`` words are decoded."""
        plain = [w.decode("utf-8", "replace") for w in token.encode("utf-8", "replace").translate(ALNUM_TABLE).split()]
        core = EDGES.sub("", token).lower()
        parts = [p for p in GAPS.split(core) if p]
        if len(parts) > 2 and all(len(p) == 1 for p in parts):
            parts = ["".join(parts)]
            plain += parts
        for word in dict.fromkeys([core, *parts, *plain]):
            if disguised(word) and (wanted is None or wanted.may_be_read(word)):
                plain += self.decoder.decode(word).split()
        return tuple(dict.fromkeys(plain))


def spaced(text: str) -> list[str]:
    """Runs of spaced-out letters and signs, with their gaps."""
    return [m[0] for m in SPACED.finditer(text) if any(ch.isalpha() for ch in m[0])]


def restored(text: str, words: Words) -> set[str]:
    """Distinct words of a text after restoration; of spaced-out letters the decoder chooses which belong together."""
    found: set[str] = set()
    for token in [*set(text.split()), *spaced(text)]:
        found.update(words[token])
    return found


def word_features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}-" for n in PREFIXES if len(word) > n)]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def training_ids(labels: DataFrame, toxic_rows: int, clean_rows: int) -> tuple[DataFrame, float]:
    """``(doc_id, toxic)`` of a bounded sample by hash order, and the prior log odds of all training labels.

    Held-out rows are left out first; a document with several labels takes the highest.
    """
    usable = labels.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pick = lambda value, n: lowest_by_hash(usable.filter(F.col("toxic") == value), ["doc_id"], n, counts.get(value, 0))
    prior = math.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5))
    return pick(1, toxic_rows).union(pick(0, clean_rows)), prior


def _sketch(text: str) -> int:
    """Smallest hash of three consecutive words; near copies share it mostly."""
    words = text.split()
    return min((xxhash.xxh3_64_intdigest(" ".join(words[i:i + 3])) for i in range(max(1, len(words) - 2))), default=0) >> 1


def evidence(docs: DataFrame, labels: DataFrame, model: np.ndarray, toxic_rows: int = TOXIC_ROWS,
             clean_rows: int = CLEAN_ROWS) -> tuple[dict[str, float], float]:
    """Lower bound of the log likelihood ratio of each telling feature, and the prior log odds.

    Fitted on at most ``toxic_rows`` and ``clean_rows`` labelled rows (the
    documented bound of the sample; the lexicon is bounded by it too), one of
    each group of near copies. A feature is a restored word or its beginning. It
    is kept where the documents with it are toxic more often than chance explains;
    a beginning also has to go on in ``BRANCHES`` ways, or it only repeats one word.
    """
    ids, prior = training_ids(labels, toxic_rows, clean_rows)
    rows = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(ids), "doc_id").select("toxic", "text")

    def sketch(batches):
        for batch in small_batches(batches):
            marks = [_sketch(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("text"), pa.array(marks, pa.int64())], names=["toxic", "text", "sketch"])

    unlike = rows.mapInArrow(sketch, "toxic int, text string, sketch long")
    unlike = unlike.groupBy("toxic", "sketch").agg(F.min("text").alias("text")).select("toxic", "text")
    handle = docs.sparkSession.sparkContext.broadcast(model)

    def count(batches):
        words, seen, following = Words(handle.value), {"": [0, 0]}, {}
        for batch in small_batches(batches):
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                names = {f: w for w in restored(text, words) for f in word_features(w)}
                for name in [*names, ""]:
                    seen.setdefault(name, [0, 0])[toxic] += 1
                if toxic:
                    for name, word in names.items():
                        if name != word:
                            following.setdefault(name, set()).add(word[len(name) - 1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array([x[0] for x in seen.values()], pa.int64()), pa.array([x[1] for x in seen.values()], pa.int64()),
             pa.array([sorted(following.get(f, ())) for f in seen], pa.list_(pa.string()))],
            names=["feature", "clean", "toxic", "following"])

    totals = unlike.mapInArrow(count, "feature string, clean long, toxic long, following array<string>").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.size(F.array_distinct(F.flatten(F.collect_set("following")))).alias("branches"))
    telling = totals.filter(f"feature = '' or (toxic >= 3 and toxic > clean and (not endswith(feature, '-') or branches >= {BRANCHES}))").collect()
    all_clean, all_toxic = next(((r["clean"], r["toxic"]) for r in telling if r["feature"] == ""), (0, 0))
    found = {}
    for r in telling:
        if r["feature"] == "":
            continue
        t, c = r["toxic"], r["clean"]
        share = all_toxic / (all_toxic + all_clean)
        gain = 2 * (t * math.log(t / ((t + c) * share)) + (c * math.log(c / ((t + c) * (1 - share))) if c else 0.0))
        ratio = math.log((t + 0.5) / (all_toxic + 1)) - math.log((c + 0.5) / (all_clean + 1))
        ratio -= CAUTION * math.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
        if gain >= LEAST_GAIN and ratio >= LEAST_EVIDENCE:
            found[r["feature"]] = min(ratio, MOST_EVIDENCE)
    return found, prior


def _scorer(handle, prior: float):
    """Function from a text column to scores, for use inside a task."""

    def start():
        words, known = Words(handle.value[0]), handle.value[1]
        wanted = Beginnings(known)
        young: dict[str, tuple] = {}
        old: dict[str, tuple] = {}

        def weighed(token: str) -> tuple:
            nonlocal young, old
            value = old.get(token)
            if value is None:
                out = []
                for w in words.read(token, wanted):
                    if w[: Beginnings.LETTERS] in wanted.whole:
                        best = max(known.get(f, 0.0) for f in word_features(w))
                        if best:
                            out.append((w, best))
                value = tuple(out)
            if len(young) >= KEPT_TOKENS:
                old, young = young, {}
            young[token] = value
            return value

        def total(text: str) -> float:
            found: dict[str, float] = {}
            for token in set(text.split()):
                hit = young.get(token)
                if hit is None:
                    hit = weighed(token)
                if hit:
                    found.update(hit)
            for run in spaced(text):
                found.update(weighed(run))
            return sum(found.values())

        def scores(texts) -> np.ndarray:
            logits = np.array([prior + (total(t) if t else 0.0) for t in texts.to_pylist()], dtype=np.float64)
            return 1.0 / (1.0 + np.exp(-np.clip(logits, -30, 30)))

        return scores

    return start


def score(docs: DataFrame, lexicon: dict[str, float], prior: float, model: np.ndarray) -> DataFrame:
    """doc_id and score of every row; a null or empty text has the prior probability."""
    start = _scorer(docs.sparkSession.sparkContext.broadcast((model, lexicon)), prior)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        scores = start()
        for batch in small_batches(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores(batch.column("text")))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def not_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, with all their columns; nothing is shuffled."""
    model = letter_model(docs)
    lexicon, prior = evidence(docs, labels, model)
    start = _scorer(docs.sparkSession.sparkContext.broadcast((model, lexicon)), prior)

    def run(batches):
        scores = start()
        for batch in small_batches(batches):
            yield batch.filter(pa.array(scores(batch.column("text")) < threshold))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    The character model counts all texts; labels are taken from rows that are
    not held out. Ids, languages, sources and labels are no inputs of a score.
    Null ids count as the empty text for the fold. Without labels or words in
    common every score is the prior.
    """
    model = letter_model(docs)
    lexicon, prior = evidence(docs, labels, model)
    return score(docs, lexicon, prior, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, labels from the training fold."""
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
