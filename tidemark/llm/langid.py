"""Language identification by a bidirectional gated recurrent network over bytes.

Two GRUs read a window of bytes forwards and backwards; every position gets a
distribution over languages from both states, and a document's probabilities are
the mean over all its positions.  Texts are read whole, in consecutive windows.

The network is trained in numpy by backpropagation through time on a bounded,
documented sample of labelled documents (``PER_LANG`` a language, chosen by the
smallest hash in as many buckets, which is an algebraic aggregate over the whole
table); predictions run inside the tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._shared import fold, table

PER_LANG = 256   # training documents a language, at most
EXCERPT = 4096   # bytes of a training document, at most; of a longer one, spans over its whole text
HIDDEN = 8       # units a direction
SPAN = 64        # bytes of a training window
WINDOW = 128     # bytes of a window when predicting
ROWS = 512       # windows read together
STEPS = 300      # training steps
BATCH = 192      # windows a training step
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
KNOWN_SHARE = 0.35  # bar of known letter runs, as a part of what training documents share with each other
FEW = 12              # runs of a text below which their share says nothing
MARGIN = 0.02       # bar of the best probability over the uniform one, as a part of what is left to 1

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32  # A-Z read as a-z


def as_bytes(text: str) -> np.ndarray:
    return FOLD[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]


def runs(x: np.ndarray) -> np.ndarray:
    """Numbers of all runs of three bytes that hold a letter (a-z or a byte beyond ASCII)."""
    if len(x) < 3:
        return np.empty(0, np.int64)
    letter = ((x >= 97) & (x <= 122)) | (x >= 128)
    some = letter[:-2] | letter[1:-1] | letter[2:]
    y = x.astype(np.int64)
    return ((y[:-2] << 16) | (y[1:-1] << 8) | y[2:])[some]


def sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class ByteGRU:
    """Parameters: ``e`` (2, 256, 3H) input by byte with its bias, ``u`` (2, H, 3H)
    recurrent, ``w`` (2H, L) and ``b`` (L) output; gates in the order z, r, n."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.langs, self.hidden = langs, hidden
        self.seen = np.zeros(1 << 21, np.uint8)  # bits of the letter runs of the training documents
        self.bar = 0.0  # least share of a text's runs that must be among them
        self.p = {
            "e": rng.normal(0, 0.3, (2, 256, 3 * hidden)).astype(np.float32),
            "u": rng.normal(0, 1 / np.sqrt(hidden), (2, hidden, 3 * hidden)).astype(np.float32),
            "w": rng.normal(0, 0.3, (2 * hidden, len(langs))).astype(np.float32),
            "b": np.zeros(len(langs), np.float32),
        }

    def states(self, x: np.ndarray, trace: list | None = None) -> np.ndarray:
        """(2, T, N, H) states; x is (N, T) bytes.  Direction 1 reads backwards."""
        e, u, h_ = self.p["e"], self.p["u"], self.hidden
        n, t = x.shape
        out = np.empty((2, t, n, h_), np.float32)
        h = np.zeros((2, n, h_), np.float32)
        for i in range(t):
            a = np.stack((e[0].take(x[:, i], axis=0), e[1].take(x[:, t - 1 - i], axis=0)))
            g = np.matmul(h, u)
            zr = sigmoid(a[:, :, :2 * h_] + g[:, :, :2 * h_])
            z, r = zr[:, :, :h_], zr[:, :, h_:]
            m = g[:, :, 2 * h_:]
            c = sigmoid(2 * (a[:, :, 2 * h_:] + r * m))
            c *= 2
            c -= 1
            new = c + z * (h - c)
            if trace is not None:
                trace.append((h, z, r, m, c))
            h = new
            out[0, i], out[1, t - 1 - i] = h[0], h[1]
        return out

    def positions(self, x: np.ndarray, trace: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """((T, N, L) probabilities of every position, the states)."""
        s = self.states(x, trace)
        h_ = self.hidden
        y = s[0] @ self.p["w"][:h_] + s[1] @ self.p["w"][h_:] + self.p["b"]
        y -= y.max(axis=2, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(axis=2, keepdims=True)
        return y, s

    def gradients(self, x: np.ndarray, label: np.ndarray) -> tuple[dict, float]:
        """Gradients of the mean cross entropy over all positions, by BPTT."""
        trace: list = []
        y, s = self.positions(x, trace)
        h_, (n, t) = self.hidden, x.shape
        rows = np.arange(n)
        loss = float(-np.log(y[:, rows, label] + 1e-9).mean())
        d = y / (n * t)
        d[:, rows, label] -= 1 / (n * t)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        for k in (0, 1):
            g["w"][k * h_:(k + 1) * h_] = np.tensordot(s[k], d, ((0, 1), (0, 1)))
        g["b"] = d.sum(axis=(0, 1))
        ds = np.stack([d @ self.p["w"][:h_].T, d @ self.p["w"][h_:].T])  # (2, T, N, H)
        u = self.p["u"]
        back = np.zeros((2, n, h_), np.float32)
        for i in range(t - 1, -1, -1):
            h, z, r, m, c = trace[i]
            dh = back + np.stack((ds[0, i], ds[1, t - 1 - i]))
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * m * r * (1 - r)
            da = np.concatenate((dz, dr, dc), axis=2)
            dg = np.concatenate((dz, dr, dc * r), axis=2)
            g["u"] += np.matmul(h.transpose(0, 2, 1), dg)
            back = dh * z + np.matmul(dg, u.transpose(0, 2, 1))
            np.add.at(g["e"][0], x[:, i], da[0])
            np.add.at(g["e"][1], x[:, t - 1 - i], da[1])
        return g, loss

    def learn_runs(self, documents: list[list[np.ndarray]]) -> None:
        """Note the runs of ``documents`` (pieces of bytes) and set the bar: ``KNOWN_SHARE`` of
        the median over documents of the share of runs that stand in another one, too."""
        found = [np.concatenate([runs(p) for p in pieces]) for pieces in documents]
        count = np.zeros(1 << 24, np.int32)
        for r in found:
            count[np.unique(r)] += 1
        self.seen = np.packbits(count > 0)
        shares = [float((count[r] > 1).mean()) for r in found if len(r)]
        self.bar = KNOWN_SHARE * float(np.median(shares)) if shares else 0.0

    def known(self, texts: list[np.ndarray], seen: np.ndarray | None = None) -> np.ndarray:
        """Share of each text's runs that training documents hold; 1 where it has fewer than
        ``FEW``, too few to tell: the network alone decides there."""
        seen = np.unpackbits(self.seen).view(bool) if seen is None else seen
        return np.array([seen[r].mean() if len(r) >= FEW else 1.0 for r in map(runs, texts)])

    def fit(self, texts: list[np.ndarray], labels: list[int], steps: int = STEPS, seed: int = 5) -> list[float]:
        """Adam on random windows, the languages drawn equally often.  A text is its
        bytes, or an array (spans, ``SPAN``) of them."""
        rng = np.random.default_rng(seed)
        by = [[i for i, k in enumerate(labels) if k == lang] for lang in range(len(self.langs))]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        losses = []
        for step in range(1, steps + 1):
            label = rng.integers(0, len(self.langs), BATCH)
            x = np.full((BATCH, SPAN), 32, np.uint8)
            for row, lang in enumerate(label):
                t = texts[by[lang][rng.integers(0, len(by[lang]))]]
                if t.ndim == 2:
                    t = t[rng.integers(0, len(t))]
                at = rng.integers(0, max(1, len(t) - SPAN + 1))
                x[row, :min(SPAN, len(t))] = t[at:at + SPAN]
            g, loss = self.gradients(x, label)
            losses.append(loss)
            norm = np.sqrt(sum(float((q * q).sum()) for q in g.values()))
            rate = 0.02 * min(1.0, 1.5 * (1 - (step - 1) / steps) + 0.02)
            for k, q in g.items():
                q = q * min(1.0, 1.0 / (norm + 1e-9))
                m[k] += 0.1 * (q - m[k])
                v[k] += 0.01 * (q * q - v[k])
                self.p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return losses

    def predict(self, texts: list[np.ndarray]) -> np.ndarray:
        """(texts, languages) mean probability over all positions; 0 for empty texts."""
        total = np.zeros((len(texts), len(self.langs)))
        size = np.array([len(t) for t in texts], np.int64)
        spans = [(i, a) for i, t in enumerate(texts) for a in range(0, len(t), WINDOW)]
        for at in range(0, len(spans), ROWS):
            some = spans[at:at + ROWS]
            x = np.full((len(some), WINDOW), 32, np.uint8)
            fill = np.empty(len(some), np.int64)
            for row, (i, a) in enumerate(some):
                part = texts[i][a:a + WINDOW]
                x[row, :len(part)] = part
                fill[row] = len(part)
            y, _ = self.positions(x)
            mask = (np.arange(WINDOW)[:, None] < fill[None, :]).astype(np.float32)
            np.add.at(total, [i for i, _ in some], np.einsum("tnl,tn->nl", y, mask))
        return total / np.maximum(size, 1)[:, None]


def excerpt(doc_id: Column, text: Column) -> Column:
    """The bytes of a text as one piece; of one longer than ``EXCERPT`` bytes as many
    spans of ``SPAN`` bytes as make up that length, one at a hash-chosen position of
    each of as many equal parts of the whole text."""
    data, n = text.cast("binary"), F.octet_length(text).cast("long")
    many = EXCERPT // SPAN

    def span(i):
        start, stop = F.floor(n * i / many), F.floor(n * (i + 1) / many)
        at = start + F.pmod(F.xxhash64(F.lit(3), doc_id, i), stop - start - SPAN + 1)
        return F.substring(data, (at + 1).cast("int"), F.lit(SPAN))

    return F.when(n > EXCERPT, F.transform(F.sequence(F.lit(0), F.lit(many - 1)), span)).otherwise(F.array(data))


def train(docs: DataFrame, per_lang: int = PER_LANG, steps: int = STEPS, hidden: int = HIDDEN) -> ByteGRU | None:
    """Fit on documents outside the held-out fold that have a label and a letter.

    The sample: a language's documents are dealt into ``per_lang`` buckets by a hash
    of their id, and each bucket gives its smallest; at most ``EXCERPT`` bytes of a
    document are learnt from, of a longer one spans over its whole text.  None if there is nothing to learn from."""
    known = docs.where(F.col("lang").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT)).where(F.col("text").rlike(r"\p{L}"))
    rank = F.struct(F.xxhash64(F.lit(1), "doc_id"), "doc_id")
    chosen = (
        known.groupBy("lang", F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(per_lang)).alias("bucket"))
        .agg(F.min_by(F.struct(F.col("doc_id"), excerpt(F.col("doc_id"), F.col("text")).alias("pieces")), rank).alias("d"))
        .select("lang", "d.*").collect()
    )
    if not chosen:
        return None
    chosen.sort(key=lambda r: (r["lang"], r["doc_id"] is None, r["doc_id"] or 0))
    langs = sorted({r["lang"] for r in chosen})
    model = ByteGRU(langs, hidden)
    pieces = [[FOLD[np.frombuffer(p, np.uint8)] for p in r["pieces"]] for r in chosen]
    model.learn_runs(pieces)
    model.fit([p[0] if len(p) == 1 else np.stack(p) for p in pieces], [langs.index(r["lang"]) for r in chosen], steps)
    return model


def identify(docs: DataFrame, model: ByteGRU | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row, from the text alone.

    ``und`` with score 0 for a null text, one without a letter, or without a model.
    Equal probabilities go to the first language by name.  Repeated rows stay."""
    langs = model.langs if model else []

    def run(batches):
        for b in batches:
            texts, letters = b.column("text").to_pylist(), b.column("letters").to_pylist()
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            todo = [i for i, ok in enumerate(letters) if ok] if model else []
            at = 0
            while at < len(todo):  # about 4 MB of text at once
                some, size = [], 0
                while at < len(todo) and size < 1 << 22:
                    some.append(todo[at])
                    size += len(texts[todo[at]])
                    at += 1
                p = model.predict([as_bytes(texts[i]) for i in some])
                for i, k, q in zip(some, p.argmax(axis=1), p.max(axis=1)):
                    lang[i], score[i] = langs[k], float(min(1.0, q))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "text",
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def accept(docs: DataFrame, model: ByteGRU | None, at_least: float | None = None) -> DataFrame:
    """``docs``, same columns, without the documents whose language is unknown: those
    without a letter, those of whose runs of three bytes too few stand in training
    documents (``bar``; the network is often sure of a script it never saw), and those
    of which no language is likelier than chance by ``MARGIN``.  A given ``at_least`` is
    the bar of the best probability and the only one.  Without a model all texts with a
    letter stay."""
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.where(has_letter)
    names, schema = docs.columns, docs.schema
    bar = model.bar if at_least is None else 0.0
    chance = 1 / len(model.langs)
    least = chance + MARGIN * (1 - chance) - 1e-6 if at_least is None else at_least

    def run(batches):
        seen = np.unpackbits(model.seen).view(bool)
        for b in batches:
            keep, texts = [], b.column(names.index("text")).to_pylist()
            for at in range(0, len(texts), 512):
                some = [as_bytes(t) for t in texts[at:at + 512]]
                keep += ((model.predict(some).max(axis=1) >= least) & (model.known(some, seen) >= bar)).tolist()
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.where(has_letter).mapInArrow(run, schema)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))
