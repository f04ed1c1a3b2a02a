"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, and one that holds the
same ordinary text and the stretches that set toxic texts apart.  A window is
compressed with both; where the toxic dictionary saves bytes, the window resembles toxic
text.  A window is one word between a fixed lead-in and tail: the lead-in lies in both
dictionaries, so that a short word is compressed rather than stored, and the tail lets
the matcher look at a word's last bytes.  A second pair of dictionaries is trained by
zstandard on samples of the two kinds of text and compared over windows of several words,
which tells phrases and contexts of usual words.  The shares of windows above several
savings of either pair go through thresholds calibrated on labelled texts that the
dictionaries did not see.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweft.llm.samples import labelled_texts
from crawlweft.llm.texts import arrow_limits, as_bytes, give_back, map_rows, words

#: Bounds of the labelled sample, in rows: toxic and ordinary.
SAMPLE_ROWS = {1: 1500, 0: 3500}
#: Sizes of the ordinary dictionary and zstandard strategies (2: two hash tables, 3: greedy, 5: lazy)
#: that the fit tries; the calibration texts decide.
SETTINGS = tuple((size, strategy) for size in (4096, 8192, 16384) for strategy in (2, 3, 5))
#: A stem must be this many times as frequent in toxic texts as in ordinary ones ...
MIN_RATIO = 10.0
#: ... and stand in so many toxic texts and places at least, and in more than chance would put there.
MIN_TEXTS = 4
#: A stem gives way to a longer one that still occurs in this part of its texts.
KEEP = 0.7
STEM = (4, 12)  # bytes of a stem
LEAD, TAIL = b"0123456789abcdefghij", b" 12345678"
SAVINGS = (1, 2, 3, 4)
MEMO_WORDS = 300_000
#: Words of a window of the trained dictionaries, the bytes of each of them, and the savings looked at.
PHRASE_WORDS = 12
PHRASE_BYTES = 32 * 1024
PHRASE_SAVINGS = (2, 5, 10)


@dataclass
class ToxicityModel:
    """The dictionaries of words and of phrases, zstandard's strategy, and the weights of a text's window statistics."""

    ordinary: bytes
    toxic: bytes
    strategy: int
    phrases: tuple[bytes, bytes]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = np.c_[(features - self.mean) / self.scale, np.ones(len(features))] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Savings(dict):
    """Bytes that the toxic dictionary saves on a word; remembers what it has compressed."""

    def __init__(self, ordinary: bytes, toxic: bytes, strategy: int):
        super().__init__()
        import zstandard as zstd

        params = zstd.ZstdCompressionParameters(
            window_log=17, hash_log=16, chain_log=16, search_log=4, min_match=4, target_length=64, strategy=strategy,
            write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        self.run = []
        for content in (ordinary, toxic):
            data = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(compression_params=params)
            self.run.append(zstd.ZstdCompressor(dict_data=data, compression_params=params).compress)

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        window = LEAD + b" " + word + TAIL
        saved = self[word] = len(self.run[0](window)) - len(self.run[1](window))
        return saved

    def features(self, raw: bytes | None) -> list[float]:
        """Log count and log share of the windows at each saving."""
        ws = words(raw)
        saved = np.fromiter(map(self.__getitem__, ws), np.int64, len(ws))
        out = []
        for least in SAVINGS:
            n = int((saved >= least).sum())
            out += [np.log1p(n), np.log(0.002 + n / max(1, len(ws)))]
        return out


def _phrase_windows(raw: bytes | None) -> list[bytes]:
    ws = words(raw)
    return [b" ".join(ws[k : k + PHRASE_WORDS]) for k in range(0, len(ws), PHRASE_WORDS)]


def train_phrases(texts: list[bytes]) -> bytes:
    """A dictionary that zstandard trains on the windows of texts; the windows themselves where they are too few."""
    import zstandard as zstd

    windows = [w for t in texts for w in _phrase_windows(t)]
    try:
        return zstd.train_dictionary(PHRASE_BYTES, windows, k=64, d=8).as_bytes()
    except zstd.ZstdError:
        return b" ".join(windows)[-PHRASE_BYTES:]


class Phrases:
    """Bytes that the dictionary trained on toxic texts saves on windows of several words."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        import zstandard as zstd

        params = zstd.ZstdCompressionParameters.from_level(3, write_content_size=0, write_checksum=0, write_dict_id=0)
        self.run = []
        for content in (ordinary, toxic):
            data = zstd.ZstdCompressionDict(content)
            data.precompute_compress(level=3)
            self.run.append(zstd.ZstdCompressor(dict_data=data, compression_params=params).compress)

    def features(self, raw: bytes | None) -> list[float]:
        """Mean saving of a text's windows, and the log count and log share of those at each saving."""
        windows = _phrase_windows(raw)
        saved = np.array([len(self.run[0](w)) - len(self.run[1](w)) for w in windows], np.int64)
        out = [float(saved.mean()) if len(saved) else 0.0]
        for least in PHRASE_SAVINGS:
            n = int((saved >= least).sum())
            out += [np.log1p(n), np.log(0.002 + n / max(1, len(windows)))]
        return out


def _starts(word: bytes) -> list[bytes]:
    return [word[:k] for k in range(STEM[0], min(len(word), STEM[1]) + 1)]


def _contexts(texts: list[bytes]) -> tuple[Counter, int]:
    """For each start of a word, in how many different pairs of neighbours it stands; and all such places.

    Copied texts and passages add nothing, so their words do not pass for frequent ones.
    """
    places = set()
    for t in texts:
        ws = [b"", *words(t), b""]
        places.update(zip(ws, ws[1:], ws[2:]))
    of_words = Counter(w for _, w, _ in places)
    stems = Counter()
    for w, n in of_words.items():
        for stem in _starts(w):
            stems[stem] += n
    return stems, len(places)


def distinctive_stems(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Starts of words that mark toxic texts, the most telling last; of nested ones the longest that keeps most texts.

    A rare stem counts when chance alone would give less than one such stem: Chernoff's
    bound for its share of toxic places, times the number of stems tried.  One text counts
    once there, so a name that fills a single text is no mark.
    """
    seen, all_toxic = _contexts(toxic)
    of_texts = Counter(s for t in toxic for s in {s for w in set(words(t)) for s in _starts(w)})
    usual, all_ordinary = _contexts(ordinary)
    share, tried = all_toxic / max(1, all_toxic + all_ordinary), max(1, len(seen))

    def beyond_chance(stem: bytes) -> bool:
        n, m = min(seen[stem], of_texts[stem]), usual[stem]
        if n < MIN_TEXTS or n <= share * (n + m):
            return False
        return n * np.log(n / (share * (n + m))) + (m * np.log(m / ((1 - share) * (n + m))) if m else 0) >= np.log(tried)

    seen = {s: n for s, n in seen.items() if beyond_chance(s)}
    ratio = {s: ((n + 0.5) / (all_toxic + 1)) / ((usual[s] + 0.5) / (all_ordinary + 1)) for s, n in seen.items()}
    kept = {s for s in seen if ratio[s] >= MIN_RATIO}
    out = []
    for stem in kept:
        if stem[:-1] in kept:
            continue
        while True:
            longer = max((s for s in kept if len(s) == len(stem) + 1 and s.startswith(stem)), key=lambda s: (seen[s], s), default=None)
            if longer is None or seen[longer] < KEEP * seen[stem]:
                break
            stem = longer
        out.append(stem)
    return sorted(out, key=lambda s: (seen[s] * np.log(ratio[s]), s))


def fit(toxic: list[str], ordinary: list[str], n_toxic: int, n_ordinary: int) -> ToxicityModel | None:
    """Train the dictionaries on seven tenths of the texts and calibrate on the rest; None without both kinds."""
    if len(toxic) < 4 or len(ordinary) < 4:
        return None
    rng = np.random.default_rng(7)
    parts = []
    for texts in (toxic, ordinary):
        raw = [texts[k].encode() for k in rng.permutation(len(texts))]
        cut = max(1, min(len(raw) - 1, len(raw) * 7 // 10))
        parts.append((raw[:cut], raw[cut:]))
    (toxic_fit, toxic_rest), (ordinary_fit, ordinary_rest) = parts
    stems = distinctive_stems(toxic_fit, ordinary_fit)
    # Ordinary words that start like a toxic one would hide the saving.
    starts = tuple(stems)
    y = np.r_[np.ones(len(toxic_rest)), np.zeros(len(ordinary_rest))]
    # The sample is richer in toxic texts than the corpus; weights undo that.
    weight = np.r_[np.full(len(toxic_rest), n_toxic / len(toxic_rest)), np.full(len(ordinary_rest), n_ordinary / len(ordinary_rest))]
    weight /= weight.sum()
    phrases = train_phrases(ordinary_fit), train_phrases(toxic_fit)
    of_phrases = list(map(Phrases(*phrases).features, toxic_rest + ordinary_rest))
    best, least = None, np.inf
    for size, strategy in SETTINGS:
        share = max(64, size // len(ordinary_fit) + 1)
        base = b" ".join(b" ".join(w for w in words(t)[: share // 4] if not w.startswith(starts))[:share] for t in ordinary_fit)[:size]
        own = b" " + b" ".join(stems) + b" "
        model = ToxicityModel(base + b" " + LEAD, base + own + LEAD, strategy, phrases, np.zeros(0), np.ones(0), np.zeros(0))
        savings = Savings(model.ordinary, model.toxic, strategy)
        loss = _calibrate(model, np.array([savings.features(t) + p for t, p in zip(toxic_rest + ordinary_rest, of_phrases, strict=True)]), y, weight)
        if loss < least:
            best, least = model, loss
    return best


def _calibrate(model: ToxicityModel, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Set a model's weights by logistic regression on texts that it did not see; the remaining loss."""
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-6
    z = np.c_[(x - model.mean) / model.scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(60):  # Newton steps with a little shrinkage
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + 1e-4 * w
        bend = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-4 * np.eye(len(w))
        w -= np.linalg.solve(bend, slope)
    model.weights = w
    return float(-(weight * np.where(y == 1, np.log(model.scores(x) + 1e-9), np.log(1 - model.scores(x) + 1e-9))).sum())


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", bounds: dict[int, int] | None = None) -> ToxicityModel | None:
    """Fit on a bounded sample (`SAMPLE_ROWS` by default) of the given labelled rows."""
    texts, counts = labelled_texts(docs, labels, label, SAMPLE_ROWS if bounds is None else bounds, doc_id, text)
    return fit(texts[1], texts[0], counts[1], counts[0])


@lru_cache(maxsize=1)
def _savings(ordinary: bytes, toxic: bytes, strategy: int, phrases: tuple[bytes, bytes]) -> tuple[Savings, Phrases]:
    """One memory of words per worker process, which its next tasks use too."""
    return Savings(ordinary, toxic, strategy), Phrases(*phrases)


def _task_scores(model: ToxicityModel | None):
    """A scorer of texts, to be sent to tasks."""

    def score(texts: list[bytes | None]) -> np.ndarray:
        if model is None or not texts:
            return np.zeros(len(texts))
        savings, phrases = _savings(model.ordinary, model.toxic, model.strategy, model.phrases)
        return model.scores(np.array([savings.features(x) + phrases.features(x) for x in texts]))

    return score


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, score (0 to 1, higher: rather toxic), predicted (1 from 0.5 on).

    Every window of the whole text counts.  Null and empty texts have no window and get
    the score of a text without any sign.  Without a model (no labels of both kinds)
    all scores are 0.  Each row gives one row where it was read; repeated and null ids are
    kept and other columns ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    scores = _task_scores(model)

    def rows(batch):
        s = scores(batch["text"].to_pylist())
        return {"doc_id": batch["doc_id"], "score": s.tolist(), "predicted": [int(x >= 0.5) for x in s]}

    return map_rows(docs.select(F.col(doc_id).alias("doc_id"), as_bytes(text)), rows, f"doc_id {kind}, score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel | None, text: str = "text") -> DataFrame:
    """`docs` with all their columns, without the rows that score 0.5 or more.  Nothing is shuffled."""
    scores = _task_scores(model)
    arrow_limits(docs.sparkSession)

    def keep(batches):
        for batch in batches:
            s = scores([None if x is None else x.encode() for x in batch.column(text).to_pylist()])
            yield batch.filter(pa.array(s < 0.5))
        give_back()

    return docs.mapInArrow(keep, docs.schema)
