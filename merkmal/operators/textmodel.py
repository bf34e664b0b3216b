"""Per-feature text classifiers: vocabulary, fit, score and ensemble.

Word and character statistics are DataFrame aggregates over all rows, and so is
the descent: a feature of at most ``max_fit_rows`` rows is fitted in one task, a
larger one in shards of that size whose weights are averaged after every pass, so
a fit depends on all rows of its feature and on no others, and each task sees one
shard and one feature's model (at most ``max_terms`` terms times ``max_classes`` classes).

A model is one table ``(model, form, feature_name, term, idf, weights, classes)``;
``form`` names the text it was fitted on, and scoring uses the same. Each term row carries one weight per class; the row with a null term carries the
intercepts and the class names.
"""

from __future__ import annotations

import io
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from merkmal.functions.patterns import once
from merkmal.functions.text import char_terms, flat_text, piped_text, plain_text, word_terms, words_of
from merkmal.operators.scale import group_tasks, rank_within, sent_if_small, top_per_group
from merkmal.session import cut_lineage

MIN_ROWS, MIN_CLASSES, MAX_CLASSES, MAX_TERMS = 30, 2, 1000, 5000
#: Rows of a feature that one task of the descent holds; a larger feature is fitted in several tasks, on all its rows.
MAX_FIT_ROWS = 20_000
#: Rows of a shard that are packed into one line, and weights in one line of a model on its way.
CHUNK_ROWS, BLOCK_WEIGHTS = 1000, 512
#: Terms and weights of a model up to these numbers are sent to all executors; results are the same beyond them.
BROADCAST_TERMS, BROADCAST_WEIGHTS = 100_000, 2_000_000
#: Classes whose margins are summed in a column each; with more, in a line each.
WIDE_CLASSES = 32
MODEL_SCHEMA = "model string, form string, feature_name string, term string, idf double, weights array<double>, classes array<string>"

#: Weights that leave a task in one batch.
OUT_ROWS = 100_000

TERMS = {"word": word_terms, "char": char_terms}
#: What a task cuts into terms: words in order, or the flat text.
PIECES = {"word": words_of, "char": flat_text}
TEXTS = {"plain": plain_text, "piped": piped_text}


def training_gate(labels: DataFrame, min_rows: int = MIN_ROWS, max_classes: int = MAX_CLASSES) -> DataFrame:
    """Features with enough rows and a usable number of distinct values."""
    counted = labels.groupBy("feature_name", "feature_value").agg(F.count("*").alias("n"))
    sizes = counted.groupBy("feature_name").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_classes"))
    return sizes.filter((F.col("n_rows") >= min_rows) & F.col("n_classes").between(MIN_CLASSES, max_classes))


def counted_terms(terms: Column) -> Column:
    """Distinct terms of one text with their number, ``array<(term, tf)>``, from runs of the sorted terms."""
    runs = lambda t: F.array_compact(F.transform(t, lambda x, i: F.when((i == 0) | (x != F.get(t, i - 1)), i)))
    count = lambda t, at: F.transform(
        at, lambda p, j: F.struct(F.get(t, p).alias("term"), (F.coalesce(F.get(at, j + 1), F.size(t)) - p).alias("tf"))
    )
    return once(F.sort_array(terms), lambda t: once(runs(t), lambda at: count(t, at)))


def term_counts(documents: DataFrame, kind: str) -> DataFrame:
    """Per (feature_name, term): documents holding it and total occurrences.

    A text labelled for several features is cut into terms once: its line holds the features with
    their numbers of documents. Terms are counted inside that line, so both counts come from one
    explode of distinct terms and one aggregate that combines on the map side.
    """
    copies = documents.filter(F.col("text").isNotNull()).groupBy("text", "feature_name").agg(F.count("*").alias("n"))
    lines = group_tasks(copies, ["text"]).groupBy("text").agg(F.collect_list(F.struct("feature_name", "n")).alias("features"))
    terms = lines.select("features", F.explode(counted_terms(TERMS[kind](F.col("text")))).alias("t"))
    marked = terms.select(F.explode("features").alias("f"), "t")
    return marked.groupBy(F.col("f.feature_name").alias("feature_name"), F.col("t.term").alias("term")).agg(
        F.sum("f.n").alias("n_docs"), F.sum(F.col("f.n") * F.col("t.tf")).alias("n_total")
    )


def vocabulary(documents: DataFrame, kind: str, max_terms: int = MAX_TERMS) -> DataFrame:
    """At most ``max_terms`` most frequent terms per feature with smooth idf."""
    sizes = documents.groupBy("feature_name").agg(F.count("*").alias("n_rows"))
    kept = top_per_group(
        term_counts(documents, kind), ["feature_name"], [F.desc("n_total"), F.asc("term")], ["term"], max_terms
    )
    idf = F.log((1 + F.col("n_rows")) / (1 + F.col("n_docs"))) + 1
    return kept.join(sizes, "feature_name").select("feature_name", "term", "n_docs", "n_total", idf.alias("idf"))


def tfidf(documents: DataFrame, vocab: DataFrame, kind: str, key: str = "uid") -> DataFrame:
    """Sublinear, L2-normalised weights per (key, feature_name, term).

    Texts are shuffled once by their key and never as terms. Where the vocabulary is small it is sent to
    them, and a text is cut once for all its features; beyond that terms meet it in a join.
    """
    vocab = cut_lineage(vocab.select("feature_name", "term", "idf"))
    held = vocab.limit(BROADCAST_TERMS + 1).toArrow()
    known = documents.filter(F.col(key).isNotNull() & F.col("feature_name").isNotNull())
    return _tfidf_sent(known, held, kind, key) if held.num_rows <= BROADCAST_TERMS else _tfidf_joined(known, vocab, kind, key)


def _tfidf_sent(documents: DataFrame, vocab: pa.Table, kind: str, key: str) -> DataFrame:
    """One line per key with its distinct texts and their features; weights leave in batches of ``OUT_ROWS``."""
    schema = documents.select(key, "feature_name", F.lit("").alias("term"), F.lit(0.0).alias("tfidf")).schema
    sent = documents.sparkSession.sparkContext.broadcast(vocab.combine_chunks())
    copies = group_tasks(documents.filter(F.col("text").isNotNull()), [key]).groupBy(key, "text", "feature_name").agg(F.count("*").alias("n"))
    texts = copies.groupBy(key, "text").agg(F.collect_list(F.struct("feature_name", "n")).alias("features"))
    lines = texts.select(key, PIECES[kind](F.col("text")).alias("pieces"), "features").groupBy(key).agg(
        F.collect_list("pieces").alias("pieces"), F.collect_list("features").alias("features")
    )

    def run(batches):
        table = sent.value.sort_by("term")
        idf, names, terms = table["idf"].to_numpy(), table["feature_name"].combine_chunks(), table["term"].combine_chunks()
        coded = names.dictionary_encode()
        feature_of, features = coded.indices.to_numpy(), {f: i for i, f in enumerate(coded.dictionary.to_pylist())}
        ids, starts = {}, []
        for place, term in enumerate(terms.to_pylist()):
            if ids.setdefault(term, len(starts)) == len(starts):
                starts.append(place)
        starts = np.array(starts, dtype=np.int64)
        held = np.diff(starts, append=len(idf))  # features that know a term

        def weights(keys, owners, sizes, known, counts, marks):
            """Of whole keys; a line is one text of the key ``owners`` names."""
            copies = np.zeros((len(sizes), len(features)), dtype=np.int64)
            for line, feature, n in marks:
                copies[line, feature] = n
            line, known = np.repeat(np.arange(len(sizes)), sizes), np.array(known, dtype=np.int64)
            spread = held[known]
            first = np.repeat(starts[known] - (np.cumsum(spread) - spread), spread)
            at, line, tf = first + np.arange(len(first)), np.repeat(line, spread), np.repeat(np.array(counts, dtype=np.int64), spread)
            tf = tf * copies[line, feature_of[at]]
            at, line, tf = at[tf > 0], line[tf > 0], tf[tf > 0]
            key_of = np.array(owners, dtype=np.int64)[line]
            if len(sizes) > len(keys):  # several texts of a key are counted together
                code, same = np.unique(key_of * len(idf) + at, return_inverse=True)
                key_of, at, tf = code // len(idf), code % len(idf), np.bincount(same, weights=tf)
            raw, group = (1 + np.log(tf)) * idf[at], key_of * len(features) + feature_of[at]
            norm = np.sqrt(np.bincount(group, weights=raw * raw))
            columns = [pa.array(keys, kept).take(pa.array(key_of)), names.take(pa.array(at)), terms.take(pa.array(at)), pa.array(raw / norm[group])]
            return pa.RecordBatch.from_arrays(columns, [key, "feature_name", "term", "tfidf"])

        for batch in batches:
            kept = batch.schema.field(key).type
            held_back, expected = ([], [], [], [], [], []), 0
            for value, pieces, marked in zip(*(batch[c].to_pylist() for c in (key, "pieces", "features"))):
                keys, owners, sizes, known, counts, marks = held_back
                keys.append(value)
                for piece, wanted in zip(pieces, marked):
                    cut = {ids[t]: tf for t, tf in Counter(piece_terms(piece, kind)).items() if t in ids}
                    here = [(len(sizes), features[m["feature_name"]], m["n"]) for m in wanted if m["feature_name"] in features]
                    owners.append(len(keys) - 1)
                    sizes.append(len(cut))
                    known.extend(cut)
                    counts.extend(cut.values())
                    marks.extend(here)
                    expected += len(cut) * max(len(here), 1)
                if expected >= OUT_ROWS:
                    yield weights(*held_back)
                    held_back, expected = ([], [], [], [], [], []), 0
            if held_back[0]:
                yield weights(*held_back)

    return lines.mapInArrow(run, schema)


def _tfidf_joined(documents: DataFrame, vocab: DataFrame, kind: str, key: str) -> DataFrame:
    """A row counts its terms (texts of a repeated key together), and norms are sums of one row per key.

    Terms are taken a second time for the result instead of being sorted to their norm.
    """
    keys = [key, "feature_name"]
    texts = group_tasks(documents, keys).groupBy(*keys).agg(F.collect_list("text").alias("texts"))
    counted = counted_terms(F.flatten(F.transform("texts", lambda t: TERMS[kind](t))))

    def weighted(rows: DataFrame, *more: str) -> DataFrame:
        terms = rows.select(*keys, *more, F.explode(counted).alias("t")).select(*keys, *more, "t.term", "t.tf")
        return terms.join(vocab, ["feature_name", "term"]).withColumn("raw", (1 + F.log("tf")) * F.col("idf"))

    norms = weighted(texts).groupBy(*keys).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    normed = texts.join(norms.hint("merge"), keys)
    return weighted(normed, "norm").select(key, "feature_name", "term", (F.col("raw") / F.col("norm")).alias("tfidf"))


# ---- helpers inside a task --------------------------------------------------------


def piece_terms(piece: list[str] | str, kind: str) -> list[str]:
    """Terms from what ``PIECES`` gives of a text."""
    if kind == "word":
        return piece + [f"{a} {b}" for a, b in zip(piece, piece[1:])]
    return [piece[i : i + n] for n in (2, 3, 4) for i in range(len(piece) - n + 1)]


def text_terms(text: str, kind: str) -> list[str]:
    """Terms of one text as ``word_terms`` and ``char_terms`` give them."""
    text = text.lower()
    return piece_terms(re.findall(r"\w{2,}", text) if kind == "word" else re.sub(r"\s\s+", " ", text), kind)


def sparse_row(text: str, kind: str, index: dict[str, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and normalised weights of the known terms of a text."""
    known = Counter(index[t] for t in text_terms(text, kind) if t in index)
    at = np.fromiter(known, dtype=np.int64, count=len(known))
    value = (1 + np.log(np.fromiter(known.values(), dtype=float, count=len(known)))) * idf[at]
    norm = np.sqrt(value @ value)
    return at, value / norm if norm > 0 else value


def fit_pass(rows: list, labels: np.ndarray, class_weight: np.ndarray, weights: np.ndarray, bias: np.ndarray,
             order: np.ndarray, step: int, stride: int = 1, factor: float = 1.0, alpha: float = 1e-4) -> tuple[float, float]:
    """One pass of stochastic descent on the modified Huber loss, one against the rest: loss seen and L2 factor.

    ``weights`` (term x class) and ``bias`` are changed in place. All classes of a
    row move in one vector step. The L2 shrinkage is kept as a common factor that
    the caller applies.
    """
    start = 1.0 / (10.0 * alpha)
    one = len(bias) == 1  # two classes share one margin: the sign says which
    signs = np.array([[-1.0], [1.0]]) if one else 2.0 * np.eye(len(bias)) - 1.0
    costs = class_weight[:, None] if one else 1.0 + np.diag(class_weight - 1.0)
    total = 0.0
    for r in order:
        at, value = rows[r]
        label = labels[r]
        eta = 1.0 / (alpha * (start + step))
        step += stride
        held = weights[at]
        z = signs[label] * (factor * (value @ held) + bias)
        factor *= max(0.0, 1.0 - eta * alpha)
        if factor < 1e-9:
            weights *= factor
            held, factor = weights[at], 1.0
        low = z.min()
        if low >= 1:
            continue
        inside = np.maximum(np.minimum(z, 1.0), -1.0)
        gap = inside - 1.0
        total += gap @ gap + (4.0 * np.maximum(inside - z, 0.0).sum() if low < -1 else 0.0)
        move = (2.0 * eta) * gap * signs[label] * costs[label]
        weights[at] = held - value[:, None] * (move / factor)
        bias -= 0.01 * move
    return total, factor


class Patience:
    """Tells when the loss of a pass has stopped falling."""

    def __init__(self, n_rows: int, patience: int = 5, tol: float = 1e-3):
        self.least, self.patience, self.best, self.waited = tol * n_rows, patience, np.inf, 0

    def ends(self, total: float) -> bool:
        self.waited = self.waited + 1 if total > self.best - self.least else 0
        self.best = min(self.best, total)
        return self.waited >= self.patience


def fit_shard(rows: list, labels: np.ndarray, class_weight: np.ndarray, weights: np.ndarray, bias: np.ndarray,
              epochs: int, seed: int) -> None:
    """Passes over rows that one task holds; ``weights`` and ``bias`` are changed in place."""
    rng = np.random.default_rng(seed)
    factor, patience = 1.0, Patience(len(rows))
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        total, factor = fit_pass(rows, labels, class_weight, weights, bias, order, epoch * len(rows), factor=factor)
        if patience.ends(total):
            break
    weights *= factor


def _packed(values: np.ndarray) -> bytes:
    """Array with its type, as bytes; whole numbers in the smallest type that holds them."""
    if values.dtype.kind in "iu":
        values = values.astype(np.min_scalar_type(int(values.max(initial=0))))
    out = io.BytesIO()
    np.save(out, values)
    return out.getvalue()


def _unpacked(values: bytes) -> np.ndarray:
    return np.load(io.BytesIO(values))


# ---- fit --------------------------------------------------------------------------


def fit(labelled: DataFrame, kind: str = "word", text: str = "plain", description_chars: int | None = None,
        min_rows: int = MIN_ROWS, max_classes: int = MAX_CLASSES, max_terms: int = MAX_TERMS, epochs: int = 100,
        seed: int = 42, max_fit_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """Model table for every feature that passes the gate.

    Vocabulary, idf, classes, class sizes and the descent come from all rows of a
    feature. ``max_fit_rows`` bounds what one task holds: a larger feature is dealt
    by seeded hash into shards of that size, every pass runs over all of them at
    once, and their weights are averaged after it.
    """
    gate = training_gate(labelled, min_rows, max_classes)
    documents = labelled.join(F.broadcast(gate.select("feature_name")), "feature_name", "left_semi").select(
        "uid", "feature_name", "feature_value", TEXTS[text](description_chars).alias("text")
    )  # the gate has one row per feature
    documents = cut_lineage(documents)
    vocab = vocabulary(documents, kind, max_terms)
    counts = documents.groupBy("feature_name", "feature_value").agg(F.count("*").alias("n"))
    classes = counts.groupBy("feature_name").agg(
        F.array_sort(F.collect_list(F.struct(F.col("feature_value").alias("value"), "n"))).alias("c")
    )  # at most max_classes entries, by the gate
    head = classes.select(
        "feature_name",
        F.lit(None).cast("string").alias("term"),
        F.lit(None).cast("double").alias("idf"),
        F.transform("c", lambda c: c["value"]).alias("classes"),
        F.transform("c", lambda c: c["n"].cast("double")).alias("sizes"),
    )
    state = head.unionByName(vocab.select("feature_name", "term", "idf"), allowMissingColumns=True)
    state = state.select(*[F.col(c).alias(c) for c in state.columns])  # no column identities shared with the rows
    large = counts.groupBy("feature_name").agg(F.sum("n").alias("n")).filter(F.col("n") > max_fit_rows)
    sizes = {r["feature_name"]: r["n"] for r in large.collect()}  # one row per feature
    marked = documents.withColumn("mark", F.xxhash64("uid", "feature_value", F.lit(seed)))
    order = ["mark", "uid", "feature_value", "text"]
    if not sizes:
        learned = _descend(_placed(marked, order), state, kind, epochs, seed)
    else:
        state, spread = cut_lineage(state), F.col("feature_name").isin(list(sizes))
        learned = _descend(_placed(marked.filter(~spread), order), state.filter(~spread), kind, epochs, seed).unionByName(
            _descend_shards(marked.filter(spread), order, state.filter(spread), sizes, kind, epochs, seed, max_fit_rows)
        )
    return learned.select(F.lit(kind).alias("model"), F.lit(text).alias("form"), "*")


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("feature_name").orderBy(*order)))


def _terms_of(state: pd.DataFrame) -> tuple[dict[str, int], np.ndarray, list, np.ndarray]:
    """Positions of the terms, idf, classes and class sizes of one feature."""
    head = state[state["term"].isna()].iloc[0]
    terms = state[state["term"].notna()].sort_values("term")
    index = {t: i for i, t in enumerate(terms["term"])}
    return index, terms["idf"].to_numpy(float), list(head["classes"]), np.array(head["sizes"], dtype=float)


def _balance(sizes: np.ndarray) -> np.ndarray:
    return sizes.sum() / (len(sizes) * sizes)


def _model_rows(feature: str, index: dict[str, int], idf: np.ndarray, classes: list, matrix: np.ndarray, bias: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "feature_name": feature,
            "term": [None, *index],
            "idf": [None, *idf],
            "weights": [bias.tolist(), *matrix.tolist()],
            "classes": [classes] + [None] * len(index),
        }
    )


LEARNED = MODEL_SCHEMA.replace("model string, form string, ", "")


def _descend(rows: DataFrame, state: DataFrame, kind: str, epochs: int, seed: int) -> DataFrame:
    """Features that one task each can hold."""

    def run(key, data: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        index, idf, classes, sizes = _terms_of(state)
        number = {c: i for i, c in enumerate(classes)}
        data = data.sort_values("place")
        vectors = [sparse_row(t, kind, index, idf) for t in data["text"]]
        matrix, bias = np.zeros((len(index), len(classes))), np.zeros(len(classes))
        one = len(classes) == 2  # a single margin, for the second class
        used, ends = (matrix[:, 1:], bias[1:]) if one else (matrix, bias)
        fit_shard(vectors, data["feature_value"].map(number).to_numpy(), _balance(sizes), used, ends, epochs, seed)
        return _model_rows(key[0], index, idf, classes, matrix, bias)

    keys = ["feature_name"]
    return group_tasks(rows, keys).groupBy(*keys).cogroup(group_tasks(state, keys).groupBy(*keys)).applyInPandas(run, LEARNED)


def _pack_shards(rows: DataFrame, state: DataFrame, kind: str) -> DataFrame:
    """Counted known terms of the texts, ``CHUNK_ROWS`` of a shard in a line, kept where the descent reads them."""

    def run(key, data: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        index, idf, classes, sizes = _terms_of(state)
        number = {c: i for i, c in enumerate(classes)}
        data = data.sort_values("place")
        labels = data["feature_value"].map(number).to_numpy().astype(np.int64)
        lines = []
        for chunk, start in enumerate(range(0, len(data), CHUNK_ROWS)):
            known = [Counter(index[t] for t in text_terms(x, kind) if t in index) for x in data["text"].iloc[start : start + CHUNK_ROWS]]
            arrays = [
                labels[start : start + CHUNK_ROWS],
                np.array([len(c) for c in known], dtype=np.int64),
                np.array([i for c in known for i in c], dtype=np.int64),
                np.array([n for c in known for n in c.values()], dtype=np.int64),
            ]
            fixed = (_packed(idf), _packed(_balance(sizes))) if chunk == 0 else (None, None)
            lines.append((*key, chunk, *map(_packed, arrays), *fixed))
        return pd.DataFrame(lines, columns=["feature_name", "shard", "chunk", "labels", "lengths", "terms", "counts", "idf", "balance"])

    keys = ["feature_name", "shard"]
    packed = group_tasks(rows, keys).groupBy(*keys).cogroup(group_tasks(state, keys).groupBy(*keys)).applyInPandas(
        run, "feature_name string, shard int, chunk int, labels binary, lengths binary, terms binary, counts binary, idf binary, balance binary"
    )
    return group_tasks(packed, keys).sortWithinPartitions(*keys).persist(StorageLevel.DISK_ONLY)


def _vectors(lengths: np.ndarray, terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> list:
    """Positions and normalised weights per text, as ``sparse_row`` gives them."""
    value = (1 + np.log(counts)) * idf[terms]
    ends = np.cumsum(lengths)
    rows = [(terms[e - n : e], value[e - n : e]) for e, n in zip(ends, lengths)]
    return [(at, v / np.sqrt(v @ v)) if len(v) and v @ v > 0 else (at, v) for at, v in rows]


def _descend_shards(rows: DataFrame, order: list[str], state: DataFrame, sizes: dict[str, int], kind: str, epochs: int,
                    seed: int, shard_rows: int) -> DataFrame:
    """Features of more rows than one task holds: every pass visits all rows, shard by shard at the same time.

    The shards of a feature start a pass from the same weights, and the mean of what they learn, by their rows,
    is where the next pass starts. Steps shrink with the rows seen in all shards. Texts are counted once; a pass
    moves weights only, in lines of ``BLOCK_WEIGHTS``. The driver holds one number per feature.
    """
    spark = rows.sparkSession
    n_shards = {f: -(-n // shard_rows) for f, n in sizes.items()}
    numbers = cut_lineage(spark.createDataFrame(list(n_shards.items()), "feature_name string, n_shards int"))
    copies = lambda df: df.join(F.broadcast(numbers), "feature_name").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1))
    ).drop("n_shards")  # one row per feature is sent
    dealt = rank_within(rows, ["feature_name"], order, "place").join(F.broadcast(numbers), "feature_name").withColumn(
        "shard", F.pmod(F.col("place") - 1, F.col("n_shards")).cast("int")
    ).select("feature_name", "shard", "place", "feature_value", "text")
    chunks = _pack_shards(dealt, copies(state), kind)

    def one_pass(epoch: int):
        def run(key, data: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
            feature, shard = key
            data = data.sort_values("chunk")
            idf, balance = _unpacked(data["idf"].iloc[0]), _unpacked(data["balance"].iloc[0])
            vectors, labels = [], []
            for line in data.itertuples():
                vectors += _vectors(*(_unpacked(x) for x in (line.lengths, line.terms, line.counts)), idf)
                labels.append(_unpacked(line.labels))
            columns = 1 if len(balance) == 2 else len(balance)  # two classes share a margin, for the second
            flat = np.zeros((len(idf) + 1) * columns) if epoch == 0 else np.concatenate([_unpacked(x) for x in model.sort_values("block")["values"]])
            weights, bias = flat[columns:].reshape(len(idf), columns), flat[:columns]
            steps = np.random.default_rng([seed, epoch, shard]).permutation(len(vectors))
            total, factor = fit_pass(
                vectors, np.concatenate(labels), balance, weights, bias, steps, epoch * sizes[feature], n_shards[feature]
            )
            weights *= factor
            starts = range(0, len(flat), BLOCK_WEIGHTS)
            return pd.DataFrame({
                "feature_name": feature, "shard": shard, "block": range(len(starts)), "n": len(vectors), "loss": total,
                "values": [_packed(flat[s : s + BLOCK_WEIGHTS]) for s in starts],
            })

        return run

    def mean(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("shard")  # the same sum whatever order the shards arrive in
        total = sum(_unpacked(v) * n for v, n in zip(parts["values"], parts["n"]))
        return pd.DataFrame([(*key, parts["loss"].sum(), _packed(total / parts["n"].sum()))], columns=["feature_name", "block", "loss", "values"])

    shard_keys, block_keys = ["feature_name", "shard"], ["feature_name", "block"]
    model = spark.createDataFrame([], "feature_name string, block int, loss double, values binary")
    waiting, done = {f: Patience(n) for f, n in sizes.items()}, []
    for epoch in range(epochs):
        now = F.col("feature_name").isin(list(waiting))
        started = group_tasks(copies(model.filter(now).select("feature_name", "block", "values")), shard_keys)
        learned = chunks.filter(now).groupBy(*shard_keys).cogroup(started.groupBy(*shard_keys)).applyInPandas(
            one_pass(epoch), "feature_name string, shard int, block int, n bigint, loss double, values binary"
        )
        model = cut_lineage(learned.groupBy(*block_keys).applyInPandas(mean, "feature_name string, block int, loss double, values binary"))
        ended = [r["feature_name"] for r in model.filter("block = 0").collect() if waiting[r["feature_name"]].ends(r["loss"])]
        if ended:
            done.append(model.filter(F.col("feature_name").isin(ended)))
            waiting = {f: p for f, p in waiting.items() if f not in ended}
        if not waiting:
            break
    if waiting:
        done.append(model.filter(F.col("feature_name").isin(list(waiting))))
    chunks.unpersist()

    def run(key, blocks: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        index, idf, classes, _ = _terms_of(state)
        flat = np.concatenate([_unpacked(x) for x in blocks.sort_values("block")["values"]]) if len(blocks) else np.zeros(0)
        matrix, bias = np.zeros((len(index), len(classes))), np.zeros(len(classes))
        columns = 1 if len(classes) == 2 else len(classes)
        if len(flat):
            matrix[:, -columns:], bias[-columns:] = flat[columns:].reshape(len(index), columns), flat[:columns]
        return _model_rows(key[0], index, idf, classes, matrix, bias)

    final = done[0] if done else model
    for more in done[1:]:
        final = final.unionByName(more)
    keys = ["feature_name"]
    return group_tasks(final, keys).groupBy(*keys).cogroup(group_tasks(state, keys).groupBy(*keys)).applyInPandas(run, LEARNED)


def _huber_slope(z: Column) -> Column:
    """Derivative of the modified Huber loss: -4 below -1, -2(1 - z) up to 1, 0 beyond."""
    return F.when(z < -1, F.lit(-4.0)).when(z < 1, -2 * (1 - z)).otherwise(F.lit(0.0))


def fit_full(labelled: DataFrame, kind: str = "word", text: str = "plain", description_chars: int | None = None,
             min_rows: int = MIN_ROWS, max_classes: int = MAX_CLASSES, max_terms: int = MAX_TERMS, epochs: int = 40,
             rate: float = 1.0, alpha: float = 1e-4) -> DataFrame:
    """Model table fitted on all rows by full-batch descent on the modified Huber loss, one against the rest.

    The same loss, class balance and L2 shrinkage as ``fit``; but every epoch is a Spark job: margins are the
    sparse join of tf-idf rows with weight rows ``(feature, term, class, w)`` summed per (row, class), the
    gradient of a weight is an aggregate over the rows holding its term, and weights and intercepts are
    checkpointed after each epoch. No task holds more than one row's terms, so a feature of any size is fitted
    on all its rows. Two classes share one margin (the second class's); the first class's weights stay 0.
    """
    gate = training_gate(labelled, min_rows, max_classes)
    documents = cut_lineage(labelled.join(F.broadcast(gate.select("feature_name")), "feature_name", "left_semi").select(
        "uid", "feature_name", "feature_value", TEXTS[text](description_chars).alias("text")
    ))
    vocab = cut_lineage(vocabulary(documents, kind, max_terms))
    counts = documents.groupBy("feature_name", "feature_value").agg(F.count("*").alias("n"))
    sizes = counts.groupBy("feature_name").agg(
        F.array_sort(F.collect_list(F.struct(F.col("feature_value").alias("value"), "n"))).alias("c"),
        F.sum("n").alias("n_rows"),
    ).select(
        "feature_name", "n_rows", F.transform("c", lambda c: c["value"]).alias("classes"),
        F.transform("c", lambda c: c["n"].cast("double")).alias("sizes"),
    )  # at most max_classes entries, by the gate
    sizes = cut_lineage(sizes)
    values = cut_lineage(tfidf(documents, vocab, kind))
    label = F.array_position("classes", F.col("feature_value")).cast("int") - 1
    k = F.size("classes")
    rows = documents.join(sizes, "feature_name").select("uid", "feature_name", "n_rows", "sizes", k.alias("k"), label.alias("label"))
    margins = rows.select(
        "*", F.explode(F.when(F.col("k") == 2, F.array(F.lit(1))).otherwise(F.sequence(F.lit(0), F.col("k") - 1))).alias("cls")
    )
    balance = F.aggregate("sizes", F.lit(0.0), lambda a, x: a + x) / (F.col("k") * F.get("sizes", F.col("label")))
    hit = F.when(F.col("k") == 2, F.col("label") == 1).otherwise(F.col("label") == F.col("cls"))
    targets = cut_lineage(margins.select(
        "uid", "feature_name", "cls", "n_rows",
        F.when(hit, 1.0).otherwise(-1.0).alias("sign"),
        F.when((F.col("k") == 2) | hit, balance).otherwise(F.lit(1.0)).alias("cost"),
    ))
    grid = vocab.select("feature_name", "term").join(sizes.select("feature_name", "classes"), "feature_name")
    weights = cut_lineage(grid.select(
        "feature_name", "term", F.explode(F.sequence(F.lit(0), F.size("classes") - 1)).alias("cls"), F.lit(0.0).alias("w")
    ))
    bias = cut_lineage(sizes.select(
        "feature_name", F.explode(F.sequence(F.lit(0), F.size("classes") - 1)).alias("cls"), F.lit(0.0).alias("b")
    ))
    for _ in range(epochs):
        sums = values.join(weights, ["feature_name", "term"]).groupBy("uid", "feature_name", "cls").agg(
            F.sum(F.col("tfidf") * F.col("w")).alias("s")
        )
        scored = targets.join(bias, ["feature_name", "cls"]).join(sums, ["uid", "feature_name", "cls"], "left")
        z = F.col("sign") * (F.col("b") + F.coalesce("s", F.lit(0.0)))
        coef = scored.select("uid", "feature_name", "cls", (F.col("sign") * _huber_slope(z) * F.col("cost") / F.col("n_rows")).alias("g"))
        coef = cut_lineage(coef.filter(F.col("g") != 0))
        grads = values.join(coef, ["uid", "feature_name"]).groupBy("feature_name", "term", "cls").agg(
            F.sum(F.col("tfidf") * F.col("g")).alias("gw")
        )
        step_b = coef.groupBy("feature_name", "cls").agg(F.sum("g").alias("gb"))
        weights = cut_lineage(weights.join(grads, ["feature_name", "term", "cls"], "left").select(
            "feature_name", "term", "cls", (F.col("w") - rate * (F.coalesce("gw", F.lit(0.0)) + alpha * F.col("w"))).alias("w")
        ))
        bias = cut_lineage(bias.join(step_b, ["feature_name", "cls"], "left").select(
            "feature_name", "cls", (F.col("b") - rate * F.coalesce("gb", F.lit(0.0))).alias("b")
        ))
    by_term = weights.groupBy("feature_name", "term").agg(F.array_sort(F.collect_list(F.struct("cls", "w"))).alias("cw"))
    terms = by_term.join(vocab.select("feature_name", "term", "idf"), ["feature_name", "term"]).select(
        "feature_name", "term", "idf", F.transform("cw", lambda x: x["w"]).alias("weights"), F.lit(None).cast("array<string>").alias("classes")
    )
    heads = bias.groupBy("feature_name").agg(F.array_sort(F.collect_list(F.struct("cls", "b"))).alias("cb")).join(
        sizes.select("feature_name", "classes"), "feature_name"
    ).select(
        "feature_name", F.lit(None).cast("string").alias("term"), F.lit(None).cast("double").alias("idf"),
        F.transform("cb", lambda x: x["b"]).alias("weights"), "classes",
    )
    return terms.unionByName(heads).select(F.lit(kind).alias("model"), F.lit(text).alias("form"), "*")


# ---- score ------------------------------------------------------------------------


def class_heads(model: DataFrame) -> DataFrame:
    """``(model, feature_name, names, biases)``: the classes of a feature's model with their intercepts."""
    return model.filter(F.col("term").isNull()).select(
        "model", "feature_name", F.col("classes").alias("names"), F.col("weights").alias("biases")
    )


def _probabilities(margins: Column) -> Column:
    """Of each class from its margin; two classes share one margin, that of the second."""
    halves = F.transform(margins, lambda m: (F.least(F.greatest(m, F.lit(-1.0)), F.lit(1.0)) + 1) / 2)

    def shares(half: Column) -> Column:
        total = F.aggregate(half, F.lit(0.0), lambda a, x: a + x)
        spread = once(total, lambda t: F.transform(half, lambda x: F.when(t > 0, x / t).otherwise(1 / F.size(half))))
        return F.when(F.size(half) == 2, F.array(1 - F.get(half, F.lit(1)), F.get(half, F.lit(1)))).otherwise(spread)

    return once(halves, shares)


def _best_class(rows: DataFrame, model: DataFrame, kind: str, small: bool, widest: int) -> DataFrame:
    """``(uid, feature_name, <kind>_value, <kind>_confidence)`` of every key that has a ``kind`` model.

    A text is cut once for all features of its uid. A term meets the weights of its classes, and
    one aggregate per row sums them and the squares, which give the norm: a column per class up to
    ``WIDE_CLASSES``, beyond that a line per (row, class). Where the model is sent to the rows,
    nothing is shuffled by term.
    """
    keys = ["uid", "feature_name"]
    known = model.filter((F.col("model") == kind) & F.col("term").isNotNull()).select("feature_name", "term", "idf", "weights")
    lines = rows.groupBy("uid", f"text_{kind}").agg(F.collect_list("feature_name").alias("features"))
    cut = lines.select("uid", "features", F.explode(counted_terms(TERMS[kind](F.col(f"text_{kind}")))).alias("t"))
    terms = cut.select("uid", F.explode("features").alias("feature_name"), "t.term", "t.tf")
    met = terms.join(F.broadcast(known) if small else known, ["feature_name", "term"])
    raw = met.select(*keys, "weights", ((1 + F.log("tf")) * F.col("idf")).alias("raw"))
    if widest <= WIDE_CLASSES:
        parts = [F.sum(F.col("raw") * F.col("raw")), *[F.sum(F.col("raw") * F.get("weights", F.lit(i))) for i in range(widest)]]
        touched = raw.groupBy(*keys).agg(*[p.alias(f"s{i}") for i, p in enumerate(parts)]).select(
            *keys, F.array(*[F.struct(F.lit(i).alias("place"), F.col(f"s{i}").alias("s")) for i in range(len(parts))]).alias("sums")
        )
    else:
        parts = raw.select(*keys, "raw", F.posexplode(F.concat(F.array("raw"), F.col("weights"))).alias("place", "w"))
        sums = parts.groupBy(*keys, "place").agg(F.sum(F.col("raw") * F.col("w")).alias("s"))
        touched = sums.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("place", "s"))).alias("sums"))
    heads = F.broadcast(class_heads(model.filter(F.col("model") == kind)).drop("model"))  # one row per feature
    grid = rows.select(*keys, "allowed").join(heads, "feature_name").join(touched.hint("merge"), keys, "left")
    norm = F.sqrt(F.get("sums", F.lit(0))["s"])
    margins = once(norm, lambda n: F.transform("biases", lambda b, i: b + F.coalesce(F.get("sums", i + 1)["s"] / n, F.lit(0.0))))
    chances = F.transform(_probabilities(margins), lambda p, i: F.struct(p.alias("p"), (-i).alias("place"), F.get("names", i).alias("name")))
    may_win = F.filter(chances, lambda c: (F.size("allowed") == 0) | F.array_contains("allowed", c["name"]))
    won = F.col("top.p") > 0
    return grid.select(*keys, F.array_max(may_win).alias("top")).select(
        *keys,
        F.when(won, F.col("top.name")).alias(f"{kind}_value"),
        F.when(won, F.col("top.p")).otherwise(F.lit(0.0)).alias(f"{kind}_confidence"),
    )


def score(rows: DataFrame, model: DataFrame, text: dict[str, str] | None = None, description_chars: int | None = None,
          slots: DataFrame | None = None) -> DataFrame:
    """Best class per row and model: ``<model>_value`` and ``<model>_confidence``, as joins and aggregates.

    ``rows`` carry uid, feature_name, category, title, description and ``allowed``
    (empty: every class may win). A class wins only with a probability over zero; rows
    whose allowed values the model doesn't know get no value and confidence 0. Rows of
    features without a model are not returned; a feature without a model of one kind
    gets no value and confidence 0 from it. Terms of a text meet the model's terms in an
    equi-join, margins are sums per (row, class), and ties go to the first class.
    Rows are keyed by (uid, feature_name): repeated keys with different texts are scored
    on the smallest (texts, allowed) and every input row gets that result. A model of
    bounded size is sent to the rows, so that no term is shuffled.
    """
    stored = model.groupBy("model", "form").agg(
        F.sum(F.size("weights")).alias("weights"), F.count("*").alias("terms"), F.max(F.size("weights")).alias("widest")
    ).collect()  # one row per model
    small = all(r["weights"] <= BROADCAST_WEIGHTS and r["terms"] <= BROADCAST_TERMS for r in stored)
    kinds = text or {"word": "plain", "char": "plain"} | {r["model"]: r["form"] for r in stored}
    used = F.broadcast(model.select("feature_name").distinct())  # one row per feature
    ready = rows.join(used, "feature_name", "left_semi").select(
        "uid", "feature_name", "category", "allowed",
        *[TEXTS[t](description_chars).alias(f"text_{k}") for k, t in kinds.items()],
    )
    ready = cut_lineage(ready)
    keys = ["uid", "feature_name"]
    first = group_tasks(ready, ["uid"]).groupBy(*keys).agg(
        F.min(F.struct(*[F.col(f"text_{k}") for k in kinds], "allowed")).alias("t")
    ).select(*keys, "t.*")
    out = ready.select(*keys, "category")
    for kind in kinds:
        best = _best_class(first, model, kind, small, max((r["widest"] for r in stored), default=0))
        out = out.join(best.hint("merge"), keys, "left").fillna({f"{kind}_confidence": 0.0})
    return out


def ensemble_choice(scored: DataFrame) -> DataFrame:
    """Agreement: mean plus 0.1; otherwise the more confident model, ties to characters."""
    agree = F.coalesce(F.col("word_value") == F.col("char_value"), F.lit(False))
    word_wins = F.col("word_confidence") > F.col("char_confidence")
    return (
        scored.withColumn("agree", agree)
        .withColumn("choice", F.when(agree | word_wins, F.col("word_value")).otherwise(F.col("char_value")))
        .withColumn(
            "choice_confidence",
            F.when(agree, (F.col("word_confidence") + F.col("char_confidence")) / 2 + 0.1)
            .when(word_wins, F.col("word_confidence"))
            .otherwise(F.col("char_confidence")),
        )
    )


def apply_choice(rows: DataFrame) -> DataFrame:
    """Open rows take the choice; categorical rows under 0.90 only on agreement over 0.5."""
    take = F.col("choice").isNotNull() & (
        F.col("predicted_value").isNull()
        | (
            (F.col("feature_type") != "numeric")
            & F.coalesce("agree", F.lit(False))
            & (F.col("confidence") < 0.90)
            & (F.col("choice_confidence") > 0.5)
        )
    )
    return (
        rows.withColumn("_take", F.coalesce(take, F.lit(False)))
        .withColumn("predicted_value", F.when(F.col("_take"), F.col("choice")).otherwise(F.col("predicted_value")))
        .withColumn("confidence", F.when(F.col("_take"), F.col("choice_confidence") * 0.7).otherwise(F.col("confidence")))
        .withColumn("layer", F.when(F.col("_take"), F.lit("ensemble")).otherwise(F.col("layer")))
        .drop("_take")
    )
