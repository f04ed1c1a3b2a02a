"""Language identification by compression.

Every language has a dictionary of raw text.  A text is cut into windows, each window
is compressed with every dictionary, and the language whose dictionary gives the
smallest total wins.  A narrow margin between the best two marks the answer as rejected.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweft.llm.texts import as_bytes, map_rows

UNDETERMINED = "und"
#: Bound of the labelled sample that the dictionaries are made from, in distinct texts of a language.
SAMPLE_ROWS = 400
DICTIONARY_BYTES = 64 * 1024
WINDOW_BYTES = 4096
LEVEL = 3
#: Relative margin below which an answer is marked as rejected.
NARROW = 0.01


def _is_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _form(text: str) -> str:
    """Lower case with single blanks, as dictionaries and texts are compared."""
    return " ".join(text.lower().split())


def train_dictionaries(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """A raw-content dictionary for each language of the labelled rows.

    At most about `sample_rows` whole texts of a language are taken, by a hash of the
    text whose cut follows the language's count of distinct texts, so copies displace
    no other text; up to `sample_rows` all are taken.  Their words are joined until the
    dictionary is full, texts taking turns.  Rows without language or text are left out.
    Only the samples reach the driver, whose bound is `sample_rows` times languages.
    """
    rows = labelled.select(F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("g")).filter("t is not null and g is not null")
    hashes = rows.select("g", F.xxhash64("t").alias("h")).distinct()
    counts = {r.g: r.n for r in hashes.groupBy("g").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    step = 1 << 30
    cut = F.element_at(F.create_map(*[x for g, n in counts.items() for x in (F.lit(g), F.lit(min(step, step * sample_rows // n)))]), F.col("g"))
    # Long texts are cut to what a dictionary can hold: it takes no more of any one.
    taken = rows.filter(F.pmod(F.xxhash64("t"), F.lit(step)) < cut).select("g", F.substring("t", 1, size).alias("t")).distinct()
    texts: dict[str, list[str]] = {}
    for r in taken.toLocalIterator():
        texts.setdefault(r.g, []).append(r.t)
    out = {}
    for g in sorted(texts):
        share = max(256, 2 * size // len(texts[g]))
        seen, parts, held = set(), [], 0
        for t in sorted(texts[g]):
            piece = _form(t)[:share].encode()
            if piece not in seen and held < size:
                seen.add(piece)
                parts.append(piece)
                held += len(piece) + 1
        out[g] = b" ".join(parts)[:size]
    return {g: x for g, x in out.items() if len(x) >= 8}


class Compressors:
    """One compressor per language; made once per task, as they cannot be sent."""

    def __init__(self, dictionaries: dict[str, bytes], level: int):
        import zstandard as zstd

        self.langs = sorted(dictionaries)
        params = zstd.ZstdCompressionParameters.from_level(level, format=zstd.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
        self.run = []
        for g in self.langs:
            data = zstd.ZstdCompressionDict(dictionaries[g], dict_type=zstd.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=level)
            self.run.append(zstd.ZstdCompressor(dict_data=data, compression_params=params).compress)

    def totals(self, raw: bytes, window: int) -> np.ndarray:
        out = np.zeros(len(self.run))
        for k in range(0, len(raw), window):
            piece = raw[k : k + window]
            out += [len(f(piece)) for f in self.run]
        return out


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    doc_id: str = "doc_id",
    text: str = "text",
    level: int = LEVEL,
    window: int = WINDOW_BYTES,
    narrow: float = NARROW,
) -> DataFrame:
    """Per document: doc_id, lang_pred, score, margin, rejected.

    Whole texts are compressed, window by window.  `margin` is the relative distance of
    the two smallest totals, `score` = margin / (margin + narrow) lies in 0 to 1, and
    `rejected` says that the margin is below `narrow`.  Null texts and texts without a
    letter are `und` with score 0; so is everything when no dictionary was learned.
    Ties go to the first language in order of code.  Each row gives one row where it was
    read; repeated and null ids are kept and other columns ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    made: list[Compressors] = []

    def one(t: str | None):
        if t is None or not dictionaries or not _is_letter(t):
            return UNDETERMINED, 0.0, 0.0, True
        totals = made[0].totals(_form(t).encode(), window)
        best = int(np.argmin(totals))
        rest = np.delete(totals, best)
        margin = float((rest.min() - totals[best]) / rest.min()) if len(rest) else 1.0
        return made[0].langs[best], margin / (margin + narrow), margin, margin < narrow

    def rows(batch):
        if not made and dictionaries:
            made.append(Compressors(dictionaries, level))
        found = zip(*(one(None if x is None else x.decode("utf-8", "replace")) for x in batch["text"].to_pylist()), strict=True)
        return {"doc_id": batch["doc_id"]} | dict(zip(("lang_pred", "score", "margin", "rejected"), map(list, found), strict=True))

    schema = f"doc_id {kind}, lang_pred string, score double, margin double, rejected boolean"
    return map_rows(docs.select(F.col(doc_id).alias("doc_id"), as_bytes(text)), rows, schema)
