"""Personal data in texts: pattern spans, and spans of a character-level bidirectional LSTM with CRF transitions.

Base spans come from four patterns (leftmost, non-overlapping per kind, failing matches dropped). The model is a
BiLSTM over character classes with a linear CRF on top, fitted in numpy with exact gradients (back-propagation
through time and forward-backward marginals) on windows of a bounded sample of documents, labelled by the base
spans of those documents. Every document is then read whole: each region around a digit or '@' is cut into
overlapping windows, every window is Viterbi-decoded, and each character takes the tag of the window in which it
stands farthest from an edge. Runs of one tag that overlap no base span and contain an '@' or ``MODEL_DIGITS``
digits are added as the model's spans. All work on documents runs in Spark tasks; the driver holds only the
bounded training windows and the weights.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from merkmal.llm.common import lowest_by_hash, read_table, small_batches

# Fixed values of the contract: kinds in their order and the base patterns.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: documents of the training sample (lowest hash of id and text), windows per document, window length, stride
TRAIN_DOCS = 1500
WINDOWS_PER_DOC = 4
LENGTH = 64
STRIDE = 32
#: characters around a digit or '@' that the model reads
REACH = 24
MODEL_DIGITS = 6
EMBED, HIDDEN = 12, 16
STEPS, BATCH, RATE = 300, 32, 0.02
CLASSES = 100  # 0 padding, 1-95 printable ASCII, 96 white space, 97 other ASCII, 98 non-ASCII
TAGS = len(KINDS) + 1  # 0: outside, k: KINDS[k - 1]

_COMPILED = {k: re.compile(p) for k, p in PATTERNS.items()}


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d)
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    digits = "".join(c for c in found if "0" <= c <= "9")
    if kind == "card":
        return 12 <= len(digits) <= 19 and _luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the patterns, in code points, end exclusive; by start, then kind order."""
    spans = []
    for kind in KINDS:
        for m in _COMPILED[kind].finditer(text or ""):
            if _valid(kind, m.group()):
                spans.append((kind, m.start(), m.end()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def char_classes(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    out = np.full(len(cp), 98, np.int64)
    out[cp < 128] = 97
    printable = (cp >= 32) & (cp <= 126)
    out[printable] = cp[printable] - 31
    out[(cp == 9) | (cp == 10) | (cp == 13)] = 96
    return out


# ---------------------------------------------------------------- model


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Weights of the BiLSTM-CRF; ``fit`` by Adam on full gradients, ``decode`` by Viterbi, both batched."""

    NAMES = ("emb", "wf", "bf", "wb", "bb", "u", "ub", "trans", "start", "end")

    def __init__(self, seed: int = 13):
        rng = np.random.default_rng(seed)
        e, h = EMBED, HIDDEN
        self.trained = False
        self.p = {
            "emb": rng.normal(0, 0.3, (CLASSES, e)),
            "wf": rng.normal(0, 1 / np.sqrt(e + h), (e + h, 4 * h)),
            "bf": np.r_[np.zeros(h), np.ones(h), np.zeros(2 * h)],
            "wb": rng.normal(0, 1 / np.sqrt(e + h), (e + h, 4 * h)),
            "bb": np.r_[np.zeros(h), np.ones(h), np.zeros(2 * h)],
            "u": rng.normal(0, 1 / np.sqrt(2 * h), (2 * h, TAGS)),
            "ub": np.zeros(TAGS),
            "trans": np.zeros((TAGS, TAGS)),
            "start": np.zeros(TAGS),
            "end": np.zeros(TAGS),
        }

    # LSTM over (B, T, E), one direction; returns outputs and the cache for back-propagation
    @staticmethod
    def _run(x, w, b):
        n, t_len, _ = x.shape
        h_dim = w.shape[1] // 4
        h, c = np.zeros((n, h_dim)), np.zeros((n, h_dim))
        hs, cache = np.zeros((n, t_len, h_dim)), []
        for t in range(t_len):
            joined_in = np.concatenate([x[:, t], h], axis=1)
            z = joined_in @ w + b
            i, f, o = _sigmoid(z[:, :h_dim]), _sigmoid(z[:, h_dim : 2 * h_dim]), _sigmoid(z[:, 2 * h_dim : 3 * h_dim])
            g = np.tanh(z[:, 3 * h_dim :])
            c_prev = c
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            hs[:, t] = h
            cache.append((joined_in, i, f, o, g, c_prev, tc))
        return hs, cache

    @staticmethod
    def _back(dhs, cache, w):
        n, t_len, h_dim = dhs.shape
        dw, db = np.zeros_like(w), np.zeros(w.shape[1])
        dx = np.zeros((n, t_len, w.shape[0] - h_dim))
        dh_next, dc_next = np.zeros((n, h_dim)), np.zeros((n, h_dim))
        for t in range(t_len - 1, -1, -1):
            joined_in, i, f, o, g, c_prev, tc = cache[t]
            dh = dhs[:, t] + dh_next
            do = dh * tc
            dc = dc_next + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c_prev * f * (1 - f), do * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            dw += joined_in.T @ dz
            db += dz.sum(0)
            dj = dz @ w.T
            dx[:, t] = dj[:, : -h_dim]
            dh_next = dj[:, -h_dim:]
            dc_next = dc * f
        return dx, dw, db

    def emissions(self, ids: np.ndarray, keep: bool = False):
        p = self.p
        x = p["emb"][ids]
        hf, cf = self._run(x, p["wf"], p["bf"])
        hb, cb = self._run(x[:, ::-1], p["wb"], p["bb"])
        both = np.concatenate([hf, hb[:, ::-1]], axis=2)
        em = both @ p["u"] + p["ub"]
        return (em, (x, cf, cb, both)) if keep else em

    def _loss_grad(self, ids: np.ndarray, tags: np.ndarray):
        p = self.p
        em, (x, cf, cb, both) = self.emissions(ids, keep=True)
        n, t_len, k = em.shape
        trans = p["trans"]
        alpha = np.zeros((n, t_len, k))
        alpha[:, 0] = p["start"] + em[:, 0]
        for t in range(1, t_len):
            s = alpha[:, t - 1, :, None] + trans[None]
            m = s.max(1)
            alpha[:, t] = m + np.log(np.exp(s - m[:, None]).sum(1)) + em[:, t]
        last = alpha[:, -1] + p["end"]
        mz = last.max(1)
        log_z = mz + np.log(np.exp(last - mz[:, None]).sum(1))
        beta = np.zeros((n, t_len, k))
        beta[:, -1] = p["end"]
        for t in range(t_len - 2, -1, -1):
            s = trans[None] + (em[:, t + 1] + beta[:, t + 1])[:, None, :]
            m = s.max(2)
            beta[:, t] = m + np.log(np.exp(s - m[:, :, None]).sum(2))
        marg = np.exp(alpha + beta - log_z[:, None, None])
        rows = np.arange(n)
        gold = em[rows[:, None], np.arange(t_len)[None], tags].sum(1) + p["start"][tags[:, 0]] + p["end"][tags[:, -1]]
        gold += trans[tags[:, :-1], tags[:, 1:]].sum(1)
        loss = float((log_z - gold).mean())
        onehot = np.eye(k)[tags]
        d_em = (marg - onehot) / n
        d_trans = np.zeros_like(trans)
        for t in range(1, t_len):
            pair = np.exp(alpha[:, t - 1, :, None] + trans[None] + (em[:, t] + beta[:, t])[:, None, :] - log_z[:, None, None])
            d_trans += pair.sum(0)
        np.add.at(d_trans, (tags[:, :-1], tags[:, 1:]), -1.0)
        grads = {
            "trans": d_trans / n,
            "start": (marg[:, 0] - onehot[:, 0]).sum(0) / n,
            "end": (marg[:, -1] - onehot[:, -1]).sum(0) / n,
            "u": both.reshape(-1, both.shape[2]).T @ d_em.reshape(-1, k),
            "ub": d_em.sum((0, 1)),
        }
        d_both = d_em @ p["u"].T
        h = HIDDEN
        dxf, grads["wf"], grads["bf"] = self._back(d_both[:, :, :h], cf, p["wf"])
        dxb, grads["wb"], grads["bb"] = self._back(d_both[:, ::-1, h:], cb, p["wb"])
        dx = dxf + dxb[:, ::-1]
        d_emb = np.zeros_like(p["emb"])
        np.add.at(d_emb, ids, dx)
        grads["emb"] = d_emb
        return loss, grads

    def fit(self, ids: np.ndarray, tags: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 5):
        """Adam on mini-batches drawn with a fixed seed; returns the losses."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        losses = []
        if not len(ids):
            return losses
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(ids), min(batch, len(ids)))
            loss, grads = self._loss_grad(ids[pick], tags[pick])
            losses.append(loss)
            self.trained = True
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            scale = min(1.0, 5.0 / max(norm, 1e-12))
            for k, g in grads.items():
                g = g * scale
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return losses

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Viterbi tags of every window (B, T)."""
        em = self.emissions(ids)
        n, t_len, k = em.shape
        score = self.p["start"] + em[:, 0]
        back = np.zeros((n, t_len, k), np.int64)
        for t in range(1, t_len):
            s = score[:, :, None] + self.p["trans"][None]
            back[:, t] = s.argmax(1)
            score = s.max(1) + em[:, t]
        score = score + self.p["end"]
        out = np.zeros((n, t_len), np.int64)
        out[:, -1] = score.argmax(1)
        for t in range(t_len - 1, 0, -1):
            out[:, t - 1] = back[np.arange(n), t, out[:, t]]
        return out


# ---------------------------------------------------------------- windows


def _window(ids: np.ndarray, start: int) -> np.ndarray:
    piece = ids[start : start + LENGTH]
    return np.pad(piece, (0, LENGTH - len(piece)))


def tag_array(n: int, spans) -> np.ndarray:
    tags = np.zeros(n, np.int64)
    for kind, a, b in spans:
        tags[a:b] = KINDS.index(kind) + 1
    return tags


def training_windows(text: str, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Up to ``WINDOWS_PER_DOC`` windows: around base spans first, then around other digits or '@', then anywhere."""
    if not text:
        return []
    ids, spans = char_classes(text), base_spans(text)
    tags = tag_array(len(ids), spans)
    rng = np.random.default_rng(seed)
    starts = [max(0, a - int(rng.integers(0, LENGTH // 2))) for _, a, _ in spans[: WINDOWS_PER_DOC // 2]]
    marks = [m.start() for m in re.finditer(r"[0-9@]", text)]
    for pick in rng.permutation(len(marks))[: WINDOWS_PER_DOC - len(starts)]:
        starts.append(max(0, marks[pick] - int(rng.integers(0, LENGTH))))
    if len(starts) < WINDOWS_PER_DOC:
        starts.append(int(rng.integers(0, max(1, len(ids) - LENGTH + 1))))
    return [(_window(ids, s), _window(tags, s)) for s in starts]


def regions(text: str) -> list[tuple[int, int]]:
    """Merged stretches within ``REACH`` characters of a digit or '@'."""
    out = []
    for m in re.finditer(r"[0-9@]", text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def window_starts(a: int, b: int, n: int) -> list[int]:
    """Starts of overlapping windows that cover [a, b) of a text of ``n`` characters."""
    if b - a <= LENGTH:
        return [max(0, min(a, n - LENGTH))]
    starts = list(range(a, b - LENGTH, STRIDE))
    return starts + [b - LENGTH]


def model_spans(model: Tagger, texts: list[str], chunk: int = 2048) -> list[list[tuple[str, int, int]]]:
    """Reconciled model spans of every text: each character takes the tag of its most central window."""
    if not model.trained:
        return [[] for _ in texts]
    jobs = []  # (text index, start)
    classes = [char_classes(t) if t else np.empty(0, np.int64) for t in texts]
    for i, t in enumerate(texts):
        if t:
            for a, b in regions(t):
                jobs.extend((i, s) for s in window_starts(a, b, len(t)))
    tags = [np.zeros(len(c), np.int64) for c in classes]
    centre = [np.full(len(c), -1, np.int64) for c in classes]
    place = np.arange(LENGTH)
    middle = np.minimum(place, LENGTH - 1 - place)
    for first in range(0, len(jobs), chunk):
        part = jobs[first : first + chunk]
        decoded = model.decode(np.stack([_window(classes[i], s) for i, s in part]))
        for (i, s), row in zip(part, decoded):
            n = min(LENGTH, len(classes[i]) - s)
            better = middle[:n] > centre[i][s : s + n]
            tags[i][s : s + n][better] = row[:n][better]
            centre[i][s : s + n][better] = middle[:n][better]
    out = []
    for t, tg in zip(texts, tags):
        spans = []
        if t and tg.any():
            edges = np.flatnonzero(np.diff(np.r_[0, tg, 0]) != 0)
            for a, b in zip(edges[:-1], edges[1:]):
                if tg[a]:
                    spans.append((KINDS[tg[a] - 1], int(a), int(b)))
        out.append(spans)
    return out


def accepted(text: str, found, base) -> list[tuple[str, int, int]]:
    """Model spans that overlap no base span and hold an '@' or ``MODEL_DIGITS`` digits."""
    out = []
    for kind, a, b in found:
        if any(a < e and s < b for _, s, e in base):
            continue
        piece = text[a:b]
        if "@" in piece or sum(c.isdigit() and c < "\x80" for c in piece) >= MODEL_DIGITS:
            out.append((kind, a, b))
    return out


# ---------------------------------------------------------------- Spark


def fitted(docs: DataFrame, rows: int = TRAIN_DOCS) -> Tagger:
    """Tagger fitted on windows of at most ``rows`` documents (lowest hash of id and text), labelled by base spans."""
    total = docs.count()
    sample = lowest_by_hash(docs.select("doc_id", "text").filter(F.col("text").isNotNull()), ["doc_id", "text"], rows, total)
    ids, tags = [], []
    for r in sample.collect():  # at most ``rows`` texts
        for w, t in training_windows(r["text"], abs(hash((r["doc_id"], len(r["text"])))) % (1 << 32)):
            ids.append(w)
            tags.append(t)
    model = Tagger()
    if ids:
        model.fit(np.stack(ids), np.stack(tags))
    return model


def found(docs: DataFrame, model: Tagger) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_model`` of every row of ``docs``."""
    weights = {k: v.copy() for k, v in model.p.items()}

    def run(batches):
        tagger = Tagger()
        tagger.p, tagger.trained = weights, model.trained
        for batch in small_batches(batches, 200):
            texts = batch.column("text").to_pylist()
            base = [base_spans(t) for t in texts]
            extra = model_spans(tagger, [t or "" for t in texts])
            counts = [[sum(1 for s in b if s[0] == k) for b in base] for k in KINDS]
            more = [accepted(t or "", e, b) for t, e, b in zip(texts, extra, base)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")]
                + [pa.array(c, pa.int64()) for c in counts]
                + [
                    pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()),
                    pa.array([joined(b + m) for b, m in zip(base, more)], pa.string()),
                    pa.array([len(m) for m in more], pa.int64()),
                ],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_model"],
            )

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_model long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def private_data(docs: DataFrame, rows: int = TRAIN_DOCS) -> DataFrame:
    """Spans of personal data in every row of ``docs (doc_id, text)``.

    Null text reads as empty and has no spans; empty texts have none either. Null and repeated doc_ids are
    returned as they are, one line per input row. Other columns, whatever their names, are not read. Texts of
    any length are read whole; the model reads only stretches near a digit or '@'. ``base_sha256`` of a text
    without base spans is the hash of the empty string. An empty table gives no rows (and a model fitted on
    nothing, which tags nothing).
    """
    return found(docs, fitted(docs, rows))


def op13_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return private_data(read_table(spark, sf_dir, "documents"))
