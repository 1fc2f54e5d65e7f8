"""Language identification with a byte convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, prepare, rows_of, table

WINDOW = 256
WIDTHS, FILTERS, CLASSES = (2, 3, 4), 16, 160
#: Bound of the labelled rows a model is fitted on: about so many for each language. Texts up to so many characters are
#: learnt whole; of a longer one, a run of that length from a place that its hash chooses. None learns all of every text.
PER_LANGUAGE, SAMPLE_CHARS = 800, 16_384
EPOCHS, BATCH, RATE = 6, 64, 0.01
UND = "und"


def _byte_classes() -> np.ndarray:
    """Class of each byte: 0 padding and controls, 1 space, 2 digit, 3 punctuation, letters without case, each byte from 128."""
    out = np.zeros(256, dtype=np.uint8)
    out[32:127] = 3
    out[[9, 10, 13, 32]] = 1
    out[48:58] = 2
    out[65:91] = out[97:123] = np.arange(4, 30)
    out[128:] = np.arange(30, 158)
    return out


BYTE_CLASS = _byte_classes()


@dataclass
class Model:
    langs: list[str]
    tables: list[np.ndarray]  # of width w: [w, CLASSES, FILTERS]
    bias: np.ndarray
    dense: np.ndarray
    out: np.ndarray

    def folded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Filters folded into look-ups of two bytes: for all widths at a position, then the third byte, then the third and fourth."""
        two = lambda t: (t[0][:, None] + t[1][None]).reshape(CLASSES * CLASSES, FILTERS)
        t2, t3, t4 = self.tables
        return np.concatenate([two(t2), two(t3), two(t4)], axis=1), t3[2], two(t4[2:])


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte classes of all texts in windows of WINDOW bytes, the last one padded, and the text each is of."""
    counts = [-(-len(t) // WINDOW) for t in texts]
    padded = b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, counts))
    return BYTE_CLASS[np.frombuffer(padded, dtype=np.uint8)].reshape(-1, WINDOW), np.repeat(np.arange(len(texts)), counts)


def train(samples: list[tuple[str, str]]) -> Model | None:
    """Fit on (language, text) with Adam; None without samples. Languages weigh alike."""
    samples = [(lang, t.encode()) for lang, t in samples if any(map(str.isalpha, t))]
    if not samples:
        return None
    langs = sorted({lang for lang, _ in samples})
    cls, owner = windows([t for _, t in samples])
    useful = (cls >= 4).sum(axis=1) >= 8
    useful |= np.bincount(owner, minlength=len(samples))[owner] == 1
    y = np.array([langs.index(lang) for lang, _ in samples])[owner]
    cls, y = cls[useful], y[useful]
    weight = (len(y) / len(langs) / np.maximum(1, np.bincount(y, minlength=len(langs))))[y].astype(np.float32)
    rng = np.random.default_rng(4)
    tables = [rng.normal(0, 0.1, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS]
    n = len(WIDTHS) * FILTERS
    params = [*tables, np.zeros(n, np.float32), rng.normal(0, 0.1, (n, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for k in range(0, len(order), BATCH):
            at = order[k : k + BATCH]
            x, rows = cls[at].astype(np.int64), np.arange(len(at))
            pooled, where = [], []
            for t, w in zip(params, WIDTHS):
                z = sum(t[j][x[:, j : WINDOW - w + 1 + j]] for j in range(w))
                best = z.argmax(axis=1)
                where.append(best)
                pooled.append(np.take_along_axis(z, best[:, None], axis=1)[:, 0])
            h = np.concatenate(pooled, axis=1) + params[3]
            a = np.maximum(h, 0)
            p = _softmax(a @ params[4] + params[5])
            p[rows, y[at]] -= 1
            g = p * weight[at, None] / len(at)
            back = (g @ params[4].T) * (h > 0)
            grads = [np.zeros_like(t) for t in params[:3]] + [back.sum(axis=0), a.T @ g, g.sum(axis=0)]
            for m, (w, best) in enumerate(zip(WIDTHS, where)):
                own = back[:, m * FILTERS : (m + 1) * FILTERS]
                for j in range(w):
                    np.add.at(grads[m][j], (np.take_along_axis(x, best + j, axis=1), np.arange(FILTERS)[None]), own)
            step += 1
            for i, (p_, g_) in enumerate(zip(params, grads)):
                first[i] = 0.9 * first[i] + 0.1 * g_
                second[i] = 0.999 * second[i] + 0.001 * g_ * g_
                p_ -= RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Model(langs, params[:3], *params[3:])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def predict(model: Model, texts: list[bytes], step: int = 48) -> np.ndarray:
    """Probabilities of each text's languages: softmax of its windows' mean output, weighted by their letters."""
    cls, owner = windows(texts)
    base, third, fourth = model.folded()
    logits = np.empty((len(cls), len(model.langs)), dtype=np.float32)
    for k in range(0, len(cls), step):
        x = cls[k : k + step].astype(np.int32)
        pair = x[:, :-1] * CLASSES + x[:, 1:]
        z = base[pair]
        z[:, :-1, FILTERS : 2 * FILTERS] += third[x[:, 2:]]
        z[:, :-2, 2 * FILTERS :] += fourth[pair[:, 2:]]
        pooled = np.concatenate([z[:, :, :FILTERS].max(axis=1), z[:, :-1, FILTERS : 2 * FILTERS].max(axis=1), z[:, :-2, 2 * FILTERS :].max(axis=1)], axis=1)
        logits[k : k + step] = np.maximum(pooled + model.bias, 0) @ model.dense + model.out
    letters = (cls >= 4).sum(axis=1).astype(np.float64)
    total = np.zeros((len(texts), len(model.langs)))
    for c in range(total.shape[1]):
        total[:, c] = np.bincount(owner, weights=letters * logits[:, c], minlength=len(texts))
    return _softmax(total / np.maximum(1, np.bincount(owner, weights=letters, minlength=len(texts)))[:, None])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, sample_chars: int | None = SAMPLE_CHARS) -> Model | None:
    """Fit on a hash-chosen sample of the labelled rows, about ``per_language`` for each language, the same in every run.

    ``sample_chars`` bounds what one text brings to the driver, so that a very long one does no harm; None takes all of it.
    """
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    if not counts:
        return None
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, per_language / n)))])
    h = F.xxhash64(F.col(id_col), F.col(text_col))
    chosen = rows.filter(F.pmod(h, F.lit(1 << 20)) < share[F.col(lang_col)] * (1 << 20))
    bound = int(1.2 * per_language * len(counts)) + 100
    text = F.col(text_col)
    if sample_chars is not None:
        start = 1 + F.pmod(F.shiftright(h, 20), F.greatest(F.lit(1), F.length(text_col) - sample_chars + 1)).cast("int")
        text = F.substring(text, start, F.lit(sample_chars))
    sample = chosen.select(F.col(lang_col), text, h.alias("h")).orderBy("h").limit(bound).collect()
    return train(sorted((r[0], r[1]) for r in sample))


_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def labels(model: Model | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, probability); 'und' and 0 for a text that is null or has no letter, or without a model."""
    out: list[tuple[str, float]] = [(UND, 0.0)] * len(texts)
    some = [k for k, t in enumerate(texts) if t and any(map(str.isalpha, t))] if model else []
    if some:
        p = predict(model, [texts[k].encode() for k in some])
        for k, row in zip(some, p):
            out[k] = (model.langs[int(row.argmax())], float(row.max()))
    return out


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of ``docs`` with the predicted language and its probability, from all windows of the whole text.

    Null, empty and letterless texts are 'und' with score 0. No other column is an input, so repeated rows
    and clashing columns do not matter; columns named as in ``into`` are replaced.
    """
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c not in into]
    schema = docs.select(*kept).schema.add(into[0], "string").add(into[1], "double")
    at = kept.index(text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts, found = b.column(at), []
            for k in range(0, len(texts), 64):
                found += labels(model, texts.slice(k, 64).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=[*kept, *into])

    return docs.select(*kept).mapInArrow(run, schema)


def op4_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~crc_mod(F.col("doc_id"), 4, 2) & F.col("doc_id").isNotNull()))
    rows = docs.select("doc_id", crc_mod(F.col("doc_id"), 4, 2).alias("held_out"), "text")
    return identify(rows, model).drop("text")
