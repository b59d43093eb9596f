"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

Inputs: a word is its own learned vector (words seen in training) beside the mean of its hashed character trigrams'
vectors (any word). A GRU reads a window of WINDOW words in both directions; attention pools its states into one logit.
Windows overlap by half and cover the whole text; a document's logit is its highest window's. A shift and scale,
fitted on training documents that the network has not seen, put the best cut of logits at THRESHOLD.

Training uses at most PER_CLASS labelled documents of each class (smallest id hashes), whole: the one bound, a parameter of fit; scoring has none. A
label says that some window is toxic, not which; so after a first pass over PER_DOC random windows of each text, all windows of all texts
are scored again and again as training goes on, and the gradient is that of each text's LOUD highest ones. The model is broadcast: its size is
fixed by VOCAB and the layer sizes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import U, lean, mix, release, slices, table, text_buffers, tune, unique_documents, word_hashes, word_spans

WINDOW, STRIDE, DIM, HIDDEN, CHARS, VOCAB = 32, 16, 8, 8, 4096, 20_000
PER_CLASS, PER_DOC, LOUD, STEPS, THRESHOLD = 2500, 6, 2, 300, 0.3
_BATCH, _WORDS = 2048, 1 << 15


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


# ---------------------------------------------------------------- words of many texts
def _distinct_words(data, off):
    """(words of each text, index of each word among the distinct, their hashes, their trigram rows and ids)."""
    s, e, n = word_spans(data, off)
    key, first, which = np.unique(word_hashes(data, s, e), return_index=True, return_inverse=True)
    s, e = s[first], e[first]
    low = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    pad = np.concatenate([low, np.zeros(2, np.uint8)]).astype(np.uint64)
    size = e - s  # trigrams begin at each byte; beyond the word's end they hold zeros
    row = np.repeat(np.arange(len(s)), size)
    at = np.repeat(s - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum())) if len(s) else np.zeros(0, np.int64)
    end = np.repeat(e, size)
    g = pad[at] | (pad[at + 1] * (at + 1 < end)) << U(8) | (pad[at + 2] * (at + 2 < end)) << U(16)
    return n, which, key, row, (mix(g) % U(CHARS)).astype(np.int64)


def _gathered(col: pa.Array):
    """_distinct_words over a whole column, by slices: memory beyond the results is a slice's."""
    data, off = text_buffers(col)
    ns, words, keys, rows, tris, base, known = [], [], [], [], [], 0, np.zeros(0, np.uint64)
    for i, j in slices(off):
        n, which, key, row, tri = _distinct_words(data[off[i] : off[j]], off[i : j + 1] - off[i])
        ns.append(n)
        words.append(key[which])
        fresh = ~np.isin(key, known, assume_unique=True)  # trigrams are kept of words not met before
        kept = fresh[row]
        keys.append(key[fresh])
        rows.append((np.cumsum(fresh) - 1)[row[kept]].astype(np.int32) + np.int32(base))
        tris.append(tri[kept].astype(np.int16))
        base += int(fresh.sum())
        known = np.union1d(known, key)
    key = np.concatenate(keys)
    rank = np.argsort(key)
    place = np.empty(base, np.int32)
    place[rank] = np.arange(base, dtype=np.int32)
    row, tri = place[np.concatenate(rows)], np.concatenate(tris)
    order = np.argsort(row, kind="stable")
    key = key[rank]
    for i, w in enumerate(words):
        words[i] = np.searchsorted(key, w).astype(np.int32)
    return np.concatenate(ns), np.concatenate(words), key, row[order], tri[order]


def _window_rows(n: np.ndarray):
    """(first word, words, text) of the overlapping windows of texts with n words each, one after the other."""
    k = np.where(n > 0, np.maximum(0, -(-(n - WINDOW) // STRIDE)) + 1, 0)
    text = np.repeat(np.arange(len(n)), k)
    i = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
    start = i * STRIDE
    return (np.cumsum(n) - n)[text] + start, np.minimum(WINDOW, n[text] - start), text


# ---------------------------------------------------------------- the network
class Net:
    """Parameters p: W char/word tables, GRU weights of both directions, attention and output."""

    def __init__(self, vocab: np.ndarray, prior: np.ndarray, seed: int = 3):
        r = np.random.default_rng(seed)
        g = lambda *shape: (r.standard_normal(shape) * 0.3 / np.sqrt(shape[0] if len(shape) > 1 else 1)).astype(np.float32)
        h, d = HIDDEN, 2 * DIM
        self.vocab = vocab
        self.p = {"words": (r.standard_normal((len(vocab) + 1, DIM)) * 0.05).astype(np.float32), "chars": (r.standard_normal((CHARS, DIM)) * 0.1).astype(np.float32)}
        self.p["words"][:-1, 0] = prior
        for way in "fb":
            self.p |= {f"W{way}": g(d, 3 * h), f"U{way}": g(h, 3 * h), f"c{way}": np.zeros(3 * h, np.float32)}
        self.p |= {"A": g(2 * h, h), "a": g(h), "o": g(2 * h), "q": np.zeros(1, np.float32)}
        self.shift, self.scale = 0.0, 1.0

    def ids(self, key: np.ndarray) -> np.ndarray:
        """Row of each word hash in the word table; the last row stands for words unseen in training."""
        if not len(self.vocab):
            return np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(self.vocab, key), len(self.vocab) - 1)
        return np.where(self.vocab[at] == key, at, len(self.vocab))

    def inputs(self, wid, row, tri, n):
        """(n, 2*DIM) inputs of n words given their rows, ascending, and trigrams."""
        out = np.empty((n, 2 * DIM), np.result_type(self.p["words"], self.p["chars"]))
        out[:, :DIM] = self.p["words"][wid]
        for i in range(0, n, _WORDS):
            m = min(_WORDS, n - i)
            lo, hi = np.searchsorted(row, (i, i + m))
            r, t = row[lo:hi] - i, tri[lo:hi]
            size = np.maximum(np.bincount(r, minlength=m), 1)
            for k in range(DIM):
                out[i : i + m, DIM + k] = np.bincount(r, self.p["chars"][t, k], m) / size
        return out

    def _walk(self, way, gate, at, mask, keep):
        """GRU states (steps, windows, HIDDEN); gate: per distinct word, the inputs' share of the three gates."""
        h, u = HIDDEN, self.p[f"U{way}"]
        state, out, tape = np.zeros((len(at), h), np.float32), [None] * at.shape[1], []
        for t in range(at.shape[1]) if way == "f" else range(at.shape[1] - 1, -1, -1):
            x, y = gate[at[:, t]], state @ u
            zr = _sigmoid(x[:, : 2 * h] + y[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            new = np.tanh(x[:, 2 * h :] + r * y[:, 2 * h :])
            nxt = (new + z * (state - new)) * mask[:, t, None]
            if keep:
                tape.append((t, state, z, r, new, y[:, 2 * h :]))
            state = out[t] = nxt
        return np.stack(out), tape

    def forward(self, x, at, mask, keep=False):
        """Logits of windows; x: distinct words' inputs, at (windows, steps): which word, mask: 1 where there is one."""
        p, hs, tapes, gates = self.p, [], {}, {}
        for way in "fb":
            gates[way] = x @ p[f"W{way}"] + p[f"c{way}"]
            s, tapes[way] = self._walk(way, gates[way], at, mask, keep)
            hs.append(s)
        hh = np.concatenate(hs, 2)  # steps, windows, 2h
        k = np.tanh(hh @ p["A"])
        e = k @ p["a"] + (mask.T - 1) * 1e9
        e = np.exp(e - e.max(0))
        w = e / e.sum(0)
        ctx = (w[:, :, None] * hh).sum(0)
        logit = ctx @ p["o"] + p["q"][0]
        return (logit, (hh, k, w, ctx, tapes)) if keep else logit

    def backward(self, x, at, mask, kept, dlogit):
        """Gradients of the parameters (but the tables) and of x."""
        p, (hh, k, w, ctx, tapes), h = self.p, kept, HIDDEN
        g = {"o": ctx.T @ dlogit, "q": dlogit.sum(keepdims=True)}
        dctx = dlogit[:, None] * p["o"]
        dw = (hh * dctx).sum(2)
        de = w * (dw - (w * dw).sum(0))
        dk = de[:, :, None] * p["a"] * (1 - k * k)
        g["a"] = np.einsum("tn,tnh->h", de, k)
        g["A"] = np.einsum("tni,tnj->ij", hh, dk)
        dhh = w[:, :, None] * dctx + dk @ p["A"].T
        dx = np.zeros_like(x)
        for way, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            u, du = p[f"U{way}"], np.zeros_like(p[f"U{way}"])
            dgate = np.zeros((len(x), 3 * h), np.float32)
            carry = np.zeros((len(at), h), np.float32)
            for t, state, z, r, new, y in reversed(tapes[way]):
                d = (carry + dhh[t, :, part]) * mask[:, t, None]
                dnew = d * (1 - z) * (1 - new * new)
                dz = d * (state - new) * z * (1 - z)
                dr = dnew * y * r * (1 - r)
                dy = np.concatenate([dz, dr, dnew * r], 1)
                du += state.T @ dy
                carry = d * z + dy @ u.T
                np.add.at(dgate, at[:, t], np.concatenate([dz, dr, dnew], 1))
            g[f"U{way}"], g[f"W{way}"], g[f"c{way}"] = du, x.T @ dgate, dgate.sum(0)
            dx += dgate @ p[f"W{way}"].T
        return g, dx

    def windows(self, x, which, first, size):
        """Logits of windows (first word, words) over texts whose words are x[which]."""
        out = np.empty(len(first), np.float32)
        for i in range(0, len(first), _BATCH):
            step = np.arange(int(size[i : i + _BATCH].max()))
            mask = (step < size[i : i + _BATCH, None]).astype(np.float32)
            at, mine = which[np.minimum(first[i : i + _BATCH, None] + step, len(which) - 1)], x
            if len(x) > at.size // 2:  # gates are made for all words given: of very many, for the batch's alone
                here, at = np.unique(at, return_inverse=True)
                mine, at = x[here], at.reshape(-1, len(step))
            out[i : i + _BATCH] = self.forward(mine, at, mask)
        return out

    def logits(self, col: pa.Array) -> np.ndarray:
        """Each text's highest window logit; -inf for texts without words."""
        data, off = text_buffers(col)
        out = [np.zeros(0, np.float32)]
        for i, j in slices(off, 1 << 20):
            part, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
            best = np.full(j - i, -np.inf, np.float32)
            n, which, key, row, tri = _distinct_words(part, o)
            if len(which):
                first, size, text = _window_rows(n)
                np.maximum.at(best, text, self.windows(self.inputs(self.ids(key), row, tri, len(key)), which, first, size))
            out.append(best)
        return np.concatenate(out)

    def scores(self, col: pa.Array) -> np.ndarray:
        z = self.logits(col).astype(np.float64)
        base = np.log(THRESHOLD / (1 - THRESHOLD))
        return np.where(np.isfinite(z), _sigmoid(np.clip(self.scale * (np.where(np.isfinite(z), z, 0) - self.shift) + base, -30, 30)), 0.0)


def train(texts, labels: np.ndarray, seed: int = 3) -> Net:
    """Fit on all texts (a list or an Arrow array) but every fifth, which set shift and scale. Labels are 0 or 1; with one class all score 0."""
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, np.float32)
    held = np.arange(len(texts)) % 5 == 4
    if not len(texts) or labels[~held].min() == labels[~held].max():
        net = Net(np.zeros(0, np.uint64), np.zeros(0, np.float32))
        net.shift = 1e9
        return net
    n, which, key, row, tri = _gathered(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
    del texts
    toxic, both, first = np.zeros(len(key)), np.zeros(len(key), np.int64), np.concatenate([[0], np.cumsum(n)])
    for i in range(len(n)):  # each word once a text
        if not held[i]:
            here = np.unique(which[first[i] : first[i + 1]])
            both[here] += 1
            toxic[here] += labels[i]
    t1, t0 = labels[~held].sum(), (1 - labels[~held]).sum()
    odds = np.log((toxic + 0.5) / (t1 + 1)) - np.log((both - toxic + 0.5) / (t0 + 1))
    odds *= both / (both + 10)  # a rare word's odds are mostly chance
    rank = np.lexsort((key, -both))
    known = np.sort(rank[: min(VOCAB, int((both >= 3).sum()))])  # key is sorted, so the vocabulary is
    net = Net(key[known], np.clip(odds[known], -1, 4).astype(np.float32), seed)
    wid = net.ids(key)
    first, size, owner = _window_rows(n)
    order = np.lexsort((rng.random(len(first)), owner))
    nth = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
    pool = order[nth < PER_DOC]
    pool = pool[~held[owner[pool]]]
    mom = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    step, rate = 0, 0.01
    weight = np.where(labels > 0, len(labels) / (2 * max(labels.sum(), 1)), len(labels) / (2 * max((1 - labels).sum(), 1))).astype(np.float32)
    tri_at = np.searchsorted(row, np.arange(len(key) + 1))
    epochs = int(np.clip(STEPS // max(1, 2 * len(n) // 256), 10, 60))
    for epoch in range(epochs):
        if epoch in (1, 2, 4, 8, 16, 32):  # the windows that speak loudest in their texts
            x = net.inputs(wid, row, tri, len(key))
            loud = net.windows(x, which, first, size)
            order = np.lexsort((-loud, owner))
            nth = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
            pool = order[nth < LOUD]
            pool = pool[~held[owner[pool]]]
        rate = 0.01 * (1 - 0.9 * epoch / epochs)
        pool = rng.permutation(pool)
        for i in range(0, len(pool), 256):
            b = pool[i : i + 256]
            span = np.arange(WINDOW)
            mask = (span < size[b, None]).astype(np.float32)
            at = which[np.minimum(first[b, None] + span, len(which) - 1)]
            here, at = np.unique(at, return_inverse=True)
            at = at.reshape(len(b), WINDOW)
            cnt = tri_at[here + 1] - tri_at[here]
            rows_ = np.repeat(np.arange(len(here)), cnt)
            tris = tri[np.repeat(tri_at[here] - (np.cumsum(cnt) - cnt), cnt) + np.arange(int(cnt.sum()))]
            w = np.where(rng.random(len(here)) < 0.1, len(net.vocab), wid[here])
            x = net.inputs(w, rows_, tris, len(here))
            logit, kept = net.forward(x, at, mask, True)
            d = (_sigmoid(logit) - labels[owner[b]]) * weight[owner[b]] / len(b)
            g, dx = net.backward(x, at, mask, kept, d.astype(np.float32))
            g["words"], g["chars"] = np.zeros_like(net.p["words"]), np.zeros_like(net.p["chars"])
            np.add.at(g["words"], w, dx[:, :DIM])
            np.add.at(g["chars"], tris, (dx[:, DIM:] / np.maximum(cnt, 1)[:, None])[rows_])
            step += 1
            for k, v in net.p.items():
                m, s = mom[k]
                m += 0.1 * (g[k] - m)
                s += 0.01 * (g[k] * g[k] - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)
    x = net.inputs(wid, row, tri, len(key))
    best = np.full(len(n), -50.0, np.float32)
    np.maximum.at(best, owner, net.windows(x, which, first, size))
    fit = held if len(np.unique(labels[held])) == 2 and labels[held].sum() >= 20 else np.ones(len(n), bool)
    z, y = best[fit].astype(np.float64), labels[fit]
    cuts = np.unique(z)
    mids = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
    f1 = [2 * (y[z >= c]).sum() / max((z >= c).sum() + y.sum(), 1) for c in mids]
    top = np.flatnonzero(np.array(f1) >= max(f1) - 1e-12)
    net.shift = float(mids[top[len(top) // 2]])
    net.scale = float(np.clip(4 / max(np.std(z), 1e-6), 0.3, 3.0))
    release()
    return net


# ---------------------------------------------------------------- on Spark
def held_out(doc_id) -> "F.Column":
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Net:
    """Train on labelled documents that are not held out; a repeated label counts as toxic if any is, of a repeated document the smallest text.

    Null ids, labels and texts and empty texts teach nothing.
    """
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id")))
    docs = documents.where(F.length("text") > 0).select("doc_id", "text")
    known = docs.select("doc_id").join(marks, "doc_id", "left_semi").distinct()
    rows, r = {}, None
    for kind in (0, 1):
        some = marks.where(F.col("toxic") == kind).join(known, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        for r in docs.join(F.broadcast(some), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect():  # per_class rows at most
            rows[r.doc_id] = r
    rows = sorted(rows.values(), key=lambda r: (r.doc_id * 2654435761 % 2**32, r.doc_id))
    labels, texts = np.array([r.toxic for r in rows]), [pa.array([r.text for r in rows], pa.large_string())]
    del rows, r  # the texts are let go as soon as their words are known
    return train(texts.pop(), labels)


def score_documents(documents: DataFrame, net: Net, name: str = "score") -> DataFrame:
    """Adds the score of column text to all rows; null and wordless texts score 0. An empty table gives no rows.

    Every row is scored by itself, so repeated rows and ids, null ids and extra columns pass through.
    """
    shared = documents.sparkSession.sparkContext.broadcast(net)
    rows = documents

    def run(batches):
        for b in batches:
            yield b.append_column(name, pa.array(shared.value.scores(b.column("text"))))

    return rows.mapInArrow(lean(run), StructType(list(rows.schema)).add(name, "double"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = unique_documents(table(spark, sf_dir, "documents"), "text")
    scored = score_documents(docs, fit(docs, table(spark, sf_dir, "labels"))).drop("text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
