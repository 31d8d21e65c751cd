"""Language identification by compression: the language whose dictionary encodes a text in the fewest bytes.

Learning takes a bounded sample of the labelled texts of each language and joins their words to a raw-content zstandard dictionary.
A text is cut into pieces, every piece is encoded once per dictionary, and the sizes are added up; pieces keep the dictionary
within reach of every byte of a very long text and bound the memory of a task. Both sides are reduced to lower-case letters with one space
between words, so that digits, markup and junk say nothing about a language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm.learning import chance
from fieldpulse.llm.tables import ship

UNDETERMINED = "und"


@dataclass(frozen=True)
class Encoder:
    """``dictionary_bytes`` per language, taken from a sample of about ``sampled`` times as many bytes. A text whose two best
    languages differ by less than ``least_margin`` of the size is rejected."""
    dictionary_bytes: int = 112 << 10
    sampled: float = 6.0
    piece_bytes: int = 8 << 10
    least_margin: float = 0.01

    def compressor(self, dictionary: bytes) -> zstandard.ZstdCompressor:
        shape = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_LAZY, min_match=5, search_log=1, target_length=8, window_log=18, chain_log=17, hash_log=17,
            write_content_size=0, write_checksum=0, write_dict_id=0)
        held = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=shape)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=shape)


@dataclass(frozen=True)
class Languages:
    """Learned languages, those with the most documents first, then by code point, and their dictionaries."""
    names: list[str]
    dictionaries: list[bytes]


def letters(text: Column) -> Column:
    """Lower-case words of letters with single spaces; null for null, empty if there is no letter."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))


def learn(docs: DataFrame, usable: Column, encoder: Encoder = Encoder()) -> Languages:
    """Dictionaries from the rows of ``docs(text, lang)`` that satisfy ``usable``.

    Rows without lang or without a letter take no part. Texts are chosen by their own hash, so all copies of a text are in or out
    together, and they count once. The sample holds ``sampled`` dictionaries of bytes per language in expectation,
    and no text brings more than one dictionary's length.
    """
    rows = docs.where(usable).where("lang is not null").select("lang", letters(F.col("text")).alias("letters"))
    rows = rows.where("letters != ''")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.octet_length("letters")).alias("bytes"))
    known = sorted(sizes.collect(), key=lambda row: (-row.docs, row.lang))
    names = [row.lang for row in known]
    if not names:
        return Languages([], [])
    share = F.create_map(*[F.lit(part) for row in known for part in (row.lang, min(1.0, encoder.sampled * encoder.dictionary_bytes / row.bytes))])
    number = chance(F.col("letters"), "languages")
    chosen = rows.where(number < F.element_at(share, F.col("lang"))).select(
        "lang", number.alias("number"), F.substring("letters", 1, encoder.dictionary_bytes).alias("letters"))
    texts: dict[str, list[bytes]] = {name: [] for name in names}
    held = dict.fromkeys(names, 0)
    for row in chosen.distinct().orderBy("lang", "number", "letters").toLocalIterator():
        if held[row.lang] < encoder.dictionary_bytes:
            texts[row.lang].append(row.letters.encode())
            held[row.lang] += len(texts[row.lang][-1]) + 1
    return Languages(names, [b" ".join(texts[name])[:encoder.dictionary_bytes] for name in names])


def sizes(text: bytes, compressors: list[zstandard.ZstdCompressor], piece: int) -> list[int]:
    """Bytes of the whole text, piece by piece, under each dictionary."""
    pieces = [text[begin:begin + piece] for begin in range(0, len(text), piece)]
    return [sum(len(one.compress(part)) for part in pieces) for one in compressors]


def judge(found: list[int]) -> tuple[int, float, float]:
    """The language of the smallest size (the first of equals), its share of 2 ** -bytes, and the margin to the next."""
    best = min(range(len(found)), key=found.__getitem__)
    rest = min((size for index, size in enumerate(found) if index != best), default=None)
    score = 1 / sum(2.0 ** max(-1000, found[best] - size) for size in found)
    return best, score, 1.0 if rest is None else (rest - found[best]) / rest


def identify(docs: DataFrame, known: Languages, encoder: Encoder = Encoder(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row of ``docs(text)`` with lang_pred, score (0 to 1), margin (0 to 1) and rejected.

    A null text, a text without a letter, and any text if no language is known, has lang_pred ``und``, score and margin 0, and is
    rejected. Others get a learned language, whatever the margin; of equal sizes the language with more documents wins, then the smaller code
    point. Rejected says that the margin is too narrow to rely on. Rows that repeat stay; other columns are not used.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(known)
    packed = docs.select(F.struct(*keep).alias("_row"), letters(F.col("text")).alias("letters"))
    kind = packed.schema["_row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = held.value
        compressors = [encoder.compressor(dictionary) for dictionary in languages.dictionaries]
        for batch in batches:
            names, scores, margins, rejected = [], [], [], []
            for text in batch.column("letters"):
                text = (text.as_py() or "").encode()
                best, score, margin = judge(sizes(text, compressors, encoder.piece_bytes)) if text and compressors else (-1, 0.0, 0.0)
                names.append(languages.names[best] if best >= 0 else UNDETERMINED)
                scores.append(score)
                margins.append(margin)
                rejected.append(margin < encoder.least_margin)
            yield pa.record_batch([batch.column("_row"), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                                   pa.array(margins, pa.float64()), pa.array(rejected, pa.bool_())],
                                  ["_row", "lang_pred", "score", "margin", "rejected"])
    found = packed.mapInArrow(run, f"_row {kind}, lang_pred string, score double, margin double, rejected boolean")
    return found.select("_row.*", "lang_pred", "score", "margin", "rejected")
