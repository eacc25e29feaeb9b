"""Language identification by prediction by partial matching (PPM) over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import fresh, small_batches

#: Bytes of context, and what stands before a text.
ORDER, PAD = 3, b"\n\n\n"
#: Training rows a language, about: the documented bound of the sample that is learned from.
SAMPLE_ROWS = 2000
#: A context is a node of the trees if the sample has it this often (over all languages).
MIN_SUPPORT = 32
#: Bytes scored at once.
BLOCK = 1 << 20
#: Predicted where there is nothing to predict from.
UNDETERMINED = "und"

RESULT = "lang_pred string, score double, bits_per_byte double"


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of the id as text is divisible by 5, or there is no id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


@dataclass
class Model:
    """Frozen code lengths: ``cost[state * symbols + symbol]`` holds the bits of a byte in each language.

    ``symbol`` numbers the bytes seen in training (the last number stands for any
    other byte); ``state`` numbers the contexts, by the symbols of the ORDER bytes
    before. The last row of ``cost`` is zero, for padding.
    """

    langs: list[str]
    symbols: int
    symbol: np.ndarray  # of a byte
    state: np.ndarray  # of ORDER symbols
    cost: np.ndarray

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Exact code length of each whole text in each language."""
        out = np.zeros((len(texts), len(self.langs)))
        for first, last, joined, starts, padding in _runs(texts):
            s = self.symbol[np.frombuffer(joined, np.uint8)]
            context = (s[:-3] * self.symbols + s[1:-2]) * self.symbols + s[2:-1]
            at = self.state[context] * self.symbols + s[3:]
            at[padding] = len(self.cost) - 1
            out[first:last] += np.add.reduceat(self.cost[at], starts, axis=0, dtype=np.float64)
        return out


def _runs(texts: list[bytes]) -> Iterator[tuple[int, int, bytes, np.ndarray, np.ndarray]]:
    """Runs of texts of about BLOCK bytes: first text, last, bytes, starts of the texts, places of padding.

    Places count predicted bytes, the first of which follows ORDER bytes of context.
    A text longer than BLOCK is dealt out in several runs, each with its true context.
    """
    i = 0
    while i < len(texts):
        if len(texts[i]) > BLOCK:
            padded = PAD + texts[i]
            for at in range(0, len(texts[i]), BLOCK):
                yield i, i + 1, padded[at:at + BLOCK + ORDER], np.array([0]), np.empty(0, np.int64)
            i += 1
            continue
        first, size = i, 0
        while i < len(texts) and len(texts[i]) <= BLOCK and size <= BLOCK:
            size += len(texts[i]) + ORDER
            i += 1
        ends = np.cumsum([len(t) + ORDER for t in texts[first:i]])
        starts = np.concatenate(([0], ends[:-1]))
        yield first, i, PAD + PAD.join(texts[first:i]) + PAD, starts, (ends[:, None] - np.arange(1, ORDER + 1)).ravel()


def gram_counts(labelled: DataFrame) -> DataFrame:
    """``lang, gram, n``: how often each byte follows each ORDER bytes; ``gram`` packs the four."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(text.encode())
            for lang, texts in by.items():
                for _, _, joined, _, padding in _runs(texts):
                    s = np.frombuffer(joined, np.uint8).astype(np.int64)
                    grams = np.delete(((s[:-3] * 256 + s[1:-2]) * 256 + s[2:-1]) * 256 + s[3:], padding)
                    gram, n = np.unique(grams, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), pa.array(gram), pa.array(n)],
                                                     names=["lang", "gram", "n"])

    small_batches(labelled.sparkSession)
    partial = labelled.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def build(langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """The trees of all languages as one table of code lengths.

    Shorter contexts are marginals of the counted grams. Contexts with MIN_SUPPORT
    are states; any other falls back to its longest suffix that is one. Within a
    state, each language codes by PPM (method C): a symbol seen c times among n, with
    d different ones, costs -log2(c / (n + d)); an unseen one costs an escape,
    -log2(d / (n + d)), and is coded in the next shorter context, in which the
    symbols already ruled out don't count; at the end the remaining byte values are
    equally likely. A context that a language has never seen is passed at no cost.
    """
    parts = [(gram >> shift) & 255 for shift in (24, 16, 8, 0)]
    seen = np.unique(np.concatenate([parts[3], np.frombuffer(PAD, np.uint8)]))
    m = len(seen) + 1
    symbol = np.full(256, m - 1, np.int64)
    symbol[seen] = np.arange(len(seen))
    a, b, c, s = (symbol[p] for p in parts)

    # states by order: codes of their symbols, longest last
    contexts = {1: c, 2: b * m + c, 3: (a * m + b) * m + c}
    state = np.zeros(m ** ORDER, np.int64)
    every = np.arange(m ** ORDER)
    kept, first = {0: np.zeros(1, np.int64)}, {0: 0}
    total = 1
    for k in range(1, ORDER + 1):
        codes, at = np.unique(contexts[k], return_inverse=True)
        kept[k] = codes[np.bincount(at, weights=n) >= MIN_SUPPORT]
        first[k], total = total, total + len(kept[k])
        number = np.full(m ** k, -1, np.int64)
        number[kept[k]] = first[k] + np.arange(len(kept[k]))
        found = number[every % m ** k]
        state = np.where(found >= 0, found, state)

    cost = np.zeros((total * m + 1, len(langs)), np.float32)
    for i in range(len(langs)):
        own = lang == i
        counts = {0: np.bincount(s[own], weights=n[own], minlength=m)[None, :]}
        index = {0: np.zeros(1, np.int64)}
        for k in range(1, ORDER + 1):  # a row for each kept context, and a last one for the others
            number = np.full(m ** k, len(kept[k]), np.int64)
            number[kept[k]] = np.arange(len(kept[k]))
            table = np.zeros((len(kept[k]) + 1, m), np.float32)
            np.add.at(table, (number[contexts[k][own]], s[own]), n[own])
            table[-1] = 0
            counts[k], index[k] = table, number
        for k in range(ORDER + 1):
            bits = _ppm([counts[j][index[j][kept[k] % m ** j] if j else np.zeros(len(kept[k]), np.int64)]
                         for j in range(k, -1, -1)], 256 - len(seen))
            cost[first[k] * m:(first[k] + len(kept[k])) * m, i] = bits.ravel()
    return Model(langs, m, symbol, state, cost)


def _ppm(chain: list[np.ndarray], others: int) -> np.ndarray:
    """Bits of each symbol, from its counts in a context and its suffixes, longest first."""
    bits = np.zeros(chain[0].shape, np.float64)
    open_ = np.ones(chain[0].shape, bool)  # symbols that no longer context has coded
    escaped = np.zeros(len(bits))
    for counts in chain:
        live = np.where(open_, counts, 0)
        n, d = live.sum(axis=1), (live > 0).sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            own = -np.log2(live / (n + d)[:, None])
            escape = np.where(n > 0, -np.log2(d / (n + d)), 0)
        coded = live > 0
        bits[coded] = (own + escaped[:, None])[coded]
        escaped = escaped + escape
        open_ &= ~coded
    left = open_[:, :-1].sum(axis=1) + others  # the last symbol stands for all unseen bytes
    uniform = np.log2(np.maximum(left, 1))
    return np.where(open_, (escaped + uniform)[:, None], bits)


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model:
    """Learn from labelled rows that are not held out: about ``sample_rows`` whole texts a language.

    The sample is by a hash of the id, so it is the same in any layout. Grams are
    counted in tasks; what reaches the driver is bounded by the sample.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).where(
        ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], 0, np.zeros(256, np.int64), np.zeros(0, np.int64), np.zeros((1, 0), np.float32))
    draw = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    share = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(sample_rows / sizes[lang]))])
    counts = gram_counts(rows.where(draw < F.element_at(share, F.col("lang")))).toArrow()
    number = {lang: i for i, lang in enumerate(langs)}
    lang = np.array([number[x] for x in counts["lang"].to_pylist()], np.int64)
    return build(langs, lang, counts["gram"].to_numpy().astype(np.int64), counts["n"].to_numpy().astype(np.float64))


def _lettered(texts: list[str]) -> np.ndarray:
    return np.array([any(map(str.isalpha, t)) for t in texts], bool)


def lettered(docs: DataFrame, text_col: str = "text") -> Column:
    """Whether a text has a letter; false for null."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("boolean")
    def has(texts: pd.Series) -> pd.Series:
        return pd.Series(_lettered([t or "" for t in texts]))

    return has(F.col(text_col).cast("string"))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """Column of struct (lang_pred, score, bits_per_byte) for whole texts, by ``model``.

    The language whose trees code the text in the fewest bits. ``score`` is its share
    of probability if all languages are equally likely before. Null texts and texts
    without a letter are ``und`` with score 0 and no code length; so is every text
    if no language was learned. Ties go to the first language in order of name.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            texts = [t or "" for t in texts]
            size = len(texts)
            raw = [t.encode() for t in texts]
            lang, score, rate = np.full(size, UNDETERMINED, object), np.zeros(size), np.full(size, np.nan)
            has = _lettered(texts)
            if model.langs and has.any():
                bits = model.bits([r for r, h in zip(raw, has, strict=True) if h])
                best = bits.argmin(axis=1)
                least = bits.min(axis=1)
                lang[has] = np.array(model.langs, object)[best]
                score[has] = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                rate[has] = least / np.array([len(r) for r, h in zip(raw, has, strict=True) if h])
            yield pd.DataFrame({"lang_pred": lang, "score": score, "bits_per_byte": rate})

    return identify(F.col(text_col).cast("string"))


def identify_languages(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
                       text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, bits_per_byte`` of every row.

    Learns from rows of ``docs`` that are labelled and not held out (:func:`train`),
    then scores every whole text under the frozen statistics (:func:`predict`).

    Defined cases: see :func:`predict` for texts; a null label is not learned from; a
    row without an id is held out; rows that repeat are predicted alike; an empty
    table gives an empty result; other columns are ignored.
    """
    model = train(docs, sample_rows, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = rows.withColumn("p", predict(rows, model))
    return scored.select("doc_id", held_out().alias("held_out"), "p.lang_pred", "p.score",
                         F.nanvl("p.bits_per_byte", F.lit(None).cast("double")).alias("bits_per_byte"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` less the rows that are ``und`` for want of a letter: null texts and texts
    without one. Where no language was learned, the other rows stay too."""
    model, result = train(docs), fresh(docs, "langid")
    if not model.langs:
        return docs.where(lettered(docs))
    judged = docs.withColumn(result, predict(docs, model))
    return judged.where(F.col(f"{result}.lang_pred") != UNDETERMINED).select(*docs.columns)
