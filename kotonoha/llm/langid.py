"""Language identification with blended-spectrum string kernels.

A text's spectrum is the set of its character n-grams of lengths 1 to 3 over a
hashed alphabet of 64 symbols; the kernel of two texts is the size of the common
set over the geometric mean of both sizes. Kernel ridge regression,
one-versus-rest, is fitted in the Nystrom space of a few landmark texts: with
landmark kernel matrix M and kernel rows k(x), the features are k(x) M^(-1/2).
A batch of texts is scored by two matrix products: presence bits times landmark
bits, then kernel rows times the folded weights.

The model is small and of bounded size: it is fitted on at most
``per_language`` labelled texts of each language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kotonoha.llm.common import column, drawn_rows, scored_texts, slices

SYMBOLS = 64
GRAMS = SYMBOLS + SYMBOLS**2 + SYMBOLS**3
# Labelled texts per language, landmarks in all, languages, ridge.
PER_LANGUAGE = 256
LANDMARKS = 96
RIDGE = 1e-3
# Code points that are turned into n-grams at one time.
CHUNK = 1 << 20
# Texts in one matrix product.
BATCH = 128

UNDETERMINED = "und"


def _alphabet() -> np.ndarray:
    """Symbol of each code point: 0 no letter, 1-26 a-z, 27-63 other letters by a hash."""
    symbols = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        if not 0xD800 <= point < 0xE000 and chr(point).isalpha():
            symbols[point] = 27 + (point * 2654435761 >> 7) % 37
    for letter in range(26):
        symbols[ord("a") + letter] = symbols[ord("A") + letter] = 1 + letter
    return symbols


_SYMBOLS: list[np.ndarray] = []


def presence(text: str | None, out: np.ndarray) -> bool:
    """Mark the n-grams of a text in ``out`` (zeros); False if it has no letter."""
    if not text:
        return False
    if not _SYMBOLS:
        _SYMBOLS.append(_alphabet())
    lowered = text.lower().encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(lowered, "<u4")
    letters = False
    for start in range(0, len(points), CHUNK):
        one = _SYMBOLS[0][points[max(0, start - 2) : start + CHUNK]].astype(np.int32)
        letters = letters or bool(one.any())
        out[one] = True
        two = one[:-1] * SYMBOLS + one[1:]
        out[SYMBOLS + two] = True
        out[SYMBOLS + SYMBOLS**2 + two[:-1] * SYMBOLS + one[2:]] = True
    return letters


def spectrum(text: str | None) -> np.ndarray:
    """The sorted n-gram numbers of a text; empty if it has no letter."""
    bits = np.zeros(GRAMS, bool)
    lettered = presence(text, bits)
    return np.flatnonzero(bits if lettered else bits[:0]).astype(np.int32)


@dataclass(frozen=True)
class KernelModel:
    """Languages, the n-grams of the landmarks, their bits, sizes and the folded weights."""

    languages: tuple[str, ...]
    grams: np.ndarray
    landmark_bits: np.ndarray
    landmark_sizes: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray

    def margins(self, bits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """One-versus-rest values of a batch of presence rows over ``grams``."""
        common = bits @ self.landmark_bits
        kernel = common / np.sqrt(np.maximum(sizes, 1))[:, None] / np.sqrt(self.landmark_sizes)[None, :]
        return kernel @ self.weights + self.offsets


def fit(spectra: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> KernelModel:
    """Nystrom kernel ridge regression; the first texts of each language are landmarks."""
    languages = tuple(sorted(set(labels)))
    each = max(4, landmarks // max(1, len(languages)))
    chosen: list[int] = []
    for language in languages:
        chosen += [i for i, y in enumerate(labels) if y == language][:each]
    grams = np.unique(np.concatenate([spectra[i] for i in chosen]))
    place = np.full(GRAMS, -1, np.int32)
    place[grams] = np.arange(len(grams))

    def rows(which) -> np.ndarray:
        bits = np.zeros((len(which), len(grams)), np.float32)
        for row, i in enumerate(which):
            at = place[spectra[i]]
            bits[row, at[at >= 0]] = 1
        return bits

    landmark_bits = rows(chosen).T.copy()
    landmark_sizes = np.array([len(spectra[i]) for i in chosen], np.float32)
    sizes = np.array([len(s) for s in spectra], np.float32)
    norm = np.sqrt(np.maximum(sizes, 1))[:, None] * np.sqrt(landmark_sizes)[None, :]
    kernel = np.concatenate(
        [rows(range(i, min(i + BATCH, len(spectra)))) @ landmark_bits for i in range(0, len(spectra), BATCH)]
    ).astype(np.float64) / norm
    values, vectors = np.linalg.eigh(kernel[chosen])
    kept = values > 1e-8 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])
    features = kernel @ root
    # Each language weighs the same, however many texts it has.
    count = {y: labels.count(y) for y in languages}
    weight = np.array([1 / count[y] for y in labels]) / len(languages)
    target = np.array([[1.0 if y == language else -1.0 for language in languages] for y in labels])
    mean, level = weight @ features, weight @ target
    centred = features - mean
    gram = (centred * weight[:, None]).T @ centred + ridge * np.eye(centred.shape[1])
    beta = np.linalg.solve(gram, (centred * weight[:, None]).T @ (target - level))
    return KernelModel(
        languages,
        grams,
        landmark_bits,
        landmark_sizes,
        (root @ beta).astype(np.float32),
        (level - mean @ beta).astype(np.float32),
    )


def labelled_spectra(
    labelled: DataFrame, *, per_language: int = PER_LANGUAGE, text_col: str = "text", lang_col: str = "lang"
) -> list[tuple[str, np.ndarray]]:
    """(language, spectrum) of at most ``per_language`` texts of each language.

    Distinct texts are drawn by hash, so the draw is repeatable and copies count
    once. About ``per_language`` are drawn; those beyond it are left out.
    """
    picked = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_text"),
        F.xxhash64(text_col).alias("_draw"),
    )
    drawn = drawn_rows(picked, "_lang", "_draw", per_language)
    texts = drawn.dropDuplicates(["_lang", "_draw"])

    def run(batches):
        for batch in slices(batches):
            bits = [spectrum(t).tobytes() for t in column(batch, "_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(bits, pa.binary())], names=["_lang", "_draw", "_grams"]
            )

    rows = (
        texts.select("_lang", "_draw", "_text")
        .mapInArrow(run, "_lang string, _draw long, _grams binary")
        .orderBy("_lang", "_draw")
        .collect()
    )
    found: dict[str, list] = {}
    for lang, _, grams in rows:
        if grams and len(found.setdefault(lang, [])) < per_language:
            found[lang].append(np.frombuffer(bytes(grams), np.int32))
    return [(lang, grams) for lang, some in found.items() for grams in some]


def train(labelled: DataFrame, *, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, **columns) -> KernelModel | None:
    """A model of the labelled texts; None if there is no labelled text with a letter.

    It knows all languages of the labelled texts; the model grows with their number.
    """
    rows = labelled_spectra(labelled, per_language=per_language, **columns)
    if not rows:
        return None
    return fit([grams for _, grams in rows], [lang for lang, _ in rows], landmarks)


def predictor(model: KernelModel | None):
    """Function from a list of texts to their lang_pred, score and margin."""
    bits = np.zeros(GRAMS, bool)

    def score(texts: list) -> dict:
        langs, scores, margins = [], [], []
        for start in range(0, len(texts), BATCH):
            some = texts[start : start + BATCH]
            rows = np.zeros((len(some), len(model.grams) if model else 0), np.float32)
            sizes = np.zeros(len(some), np.float32)
            for row, text in enumerate(some):
                bits[:] = False
                if model and presence(text, bits):
                    sizes[row] = np.count_nonzero(bits)
                    rows[row] = bits[model.grams]
            values = model.margins(rows, sizes) if model else np.zeros((len(some), 1))
            for row, at in enumerate(values.argmax(axis=1).tolist()):
                ok = sizes[row] > 0
                margin = float(values[row, at])
                langs.append(model.languages[at] if ok else UNDETERMINED)
                scores.append(min(1.0, max(0.0, (margin + 1) / 2)) if ok else 0.0)
                margins.append(margin if ok else -1.0)
        return {"lang_pred": langs, "score": scores, "margin": margins}

    return score


def identify(
    docs: DataFrame, model: KernelModel | None, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, lang_pred, score, margin) for every row, from the whole text alone.

    ``lang_pred`` is the language of the largest margin (ties: the first by
    name), ``score`` maps that margin from -1..1 to 0..1. Missing texts and texts
    without a letter are ``und`` with score 0, and so is every text if there is
    no model. Rows may repeat, ids may be missing, other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by LANDMARKS
    return scored_texts(
        docs, lambda: predictor(shared.value), "lang_pred string, score double, margin double",
        {"lang_pred": pa.string(), "score": pa.float64(), "margin": pa.float64()},
        id_col=id_col, text_col=text_col,
    )


def filter_languages(
    docs: DataFrame, model: KernelModel | None, *, min_score: float, text_col: str = "text"
) -> DataFrame:
    """The rows whose text has a language with at least ``min_score``, all columns untouched.

    Without a model every text with a letter stays.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = shared.value
        score = predictor(known)
        for batch in slices(batches):
            texts = column(batch, text_col)
            if known:
                found = score(texts)
                keep = [
                    lang != UNDETERMINED and value >= min_score
                    for lang, value in zip(found["lang_pred"], found["score"], strict=True)
                ]
            else:
                keep = [any(map(str.isalpha, t or "")) for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
