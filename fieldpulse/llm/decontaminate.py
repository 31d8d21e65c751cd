"""Benchmark decontamination with an FM-index per training shard.

A task reads its documents as shards of some hundred thousand words. Words become symbols of the benchmark's vocabulary and
each run of other words one separator, which no test phrase holds, so no occurrence is lost. The shard is
indexed, every distinct window of the benchmark is searched backwards through the wavelet ranks, occurrences are
located through sampled suffix positions, and the words they cover are merged into removal spans.

The benchmark is handed to the tasks in blocks of about ``Windows.block_words`` words. A block holds the words of its items once, as numbers, and
every distinct window as a place in them, some 40 bytes a word in all. A larger benchmark takes one pass over the documents per block, each
adding its spans to the rows, which are written in between.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm.fm_index import FMIndex
from fieldpulse.llm.tables import ship, stored
from fieldpulse.llm.words import Slice, Words, shingles, slices, words

SEPARATOR = 1
SHARD_WORDS = 1 << 18
MAX_SYMBOLS = 1 << 19


@dataclass(frozen=True)
class Windows:
    """A window is ``size`` consecutive words of an item; an item of fewer words, but not none, is one window."""
    size: int = 10
    block_words: int = 1 << 21


@dataclass
class Phrases:
    """A benchmark block: its words as symbols, the distinct windows as places in them, and the items that hold each."""
    vocabulary: np.ndarray
    symbols: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    item_begins: np.ndarray
    items: np.ndarray
    names: list[str | None] = field(default_factory=list)


def _null_last(name: str | None) -> tuple[bool, str]:
    return name is None, name or ""


def phrases(item_ids: list, texts: list[str | None], size: int) -> Phrases:
    """Windows are told apart by 64-bit hashes of their words, like the words themselves."""
    item_names = [None if item is None else str(item) for item in item_ids]
    names = sorted(set(item_names), key=_null_last)
    number = {name: index for index, name in enumerate(names)}
    part = next(slices(pa.array(texts, pa.string()), 1 << 62), Slice(0, 0, np.zeros(0, np.uint8), np.zeros(1, np.int64)))
    found = words(part)
    vocabulary, symbols = np.unique(found.hash, return_inverse=True)
    hashes, begins = shingles(found, part.n_docs, size)
    firsts = np.searchsorted(found.doc, np.arange(part.n_docs + 1)).astype(np.int32)
    doc = np.repeat(np.arange(part.n_docs, dtype=np.int32), np.diff(begins))
    start = firsts[doc] + (np.arange(len(doc)) - begins[doc]).astype(np.int32)
    owner = np.array([number[name] for name in item_names] or [0], np.int32)[doc]
    order = np.lexsort((owner, hashes))
    hashes, owner, start, doc = hashes[order], owner[order], start[order], doc[order]
    fresh = np.concatenate([[True], hashes[1:] != hashes[:-1]])[:len(hashes)]
    held = fresh | np.concatenate([[True], owner[1:] != owner[:-1]])[:len(hashes)]
    return Phrases(vocabulary, (symbols + SEPARATOR + 1).astype(np.int32), start[fresh], np.minimum(size, firsts[doc[fresh] + 1] - start[fresh]),
                   np.append(np.flatnonzero(fresh[held]), held.sum()), owner[held], names)


def _occurrences(found: Words, known: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(word number, window) of every occurrence of a window in the words of a shard."""
    at = np.minimum(np.searchsorted(known.vocabulary, found.hash), len(known.vocabulary) - 1)
    inside = known.vocabulary[at] == found.hash
    symbol = np.where(inside, at + SEPARATOR + 1, SEPARATOR)
    fresh = np.concatenate([[True], found.doc[1:] != found.doc[:-1]])
    # A separator before each document, and one for each run of words outside the vocabulary.
    keep = inside | fresh | np.concatenate([[True], inside[:-1]])
    number = np.flatnonzero(keep)
    symbol, fresh = symbol[keep], fresh[keep]
    place = np.arange(len(number)) + np.cumsum(fresh)
    text, origin = (np.full(len(number) + int(fresh.sum()), fill, np.int32) for fill in (SEPARATOR, 0))
    text[place], origin[place] = symbol, number
    del symbol, place, inside, at, keep, number, fresh
    starts, windows = [], []
    size = int(known.lengths.max())
    for begin in range(0, len(text), MAX_SYMBOLS):
        index = FMIndex(text[begin:begin + MAX_SYMBOLS + size - 1], len(known.vocabulary) + SEPARATOR)
        low, high = index.search(known.symbols, known.starts, known.lengths)
        hit = np.flatnonzero(high > low)
        counts = high[hit] - low[hit]
        rows = np.repeat(low[hit], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts.append(origin[begin + index.locate(rows)])
        windows.append(np.repeat(hit, counts))
    return np.concatenate(starts), np.concatenate(windows)


def _spans(found: Words, known: Phrases, n_docs: int) -> tuple[np.ndarray, list, list]:
    """Words per document, and each document's merged spans (bytes of the slice, words of the document) and items."""
    count = np.bincount(found.doc, minlength=n_docs)
    spans: list = [[] for _ in range(n_docs)]
    items: list = [[] for _ in range(n_docs)]
    if not len(found.doc) or not len(known.starts):
        return count, spans, items
    start, window = _occurrences(found, known)
    if not len(start):
        return count, spans, items
    change = np.zeros(len(found.doc) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + known.lengths[window], -1)
    covered = np.cumsum(change[:-1]) > 0
    fresh = np.concatenate([[True], found.doc[1:] != found.doc[:-1]])
    firsts = np.flatnonzero(covered & (fresh | np.concatenate([[True], ~covered[:-1]])))
    lasts = np.flatnonzero(covered & (np.concatenate([fresh[1:], [True]]) | np.concatenate([~covered[1:], [True]])))
    begins = np.cumsum(count) - count
    for one, two in zip(firsts, lasts):
        doc = int(found.doc[one])
        spans[doc].append((int(found.start[one]), int(found.end[two]), int(one - begins[doc]), int(two + 1 - begins[doc])))
    pairs = np.unique(found.doc[start].astype(np.int64) * len(known.starts) + window)
    for pair in pairs:
        doc, held = divmod(int(pair), len(known.starts))
        items[doc].extend(known.items[known.item_begins[held]:known.item_begins[held + 1]].tolist())
    return count, spans, items


def _joined(parts: list[tuple[Slice, Words]]) -> tuple[Words, int]:
    """The words of several slices as one shard, documents numbered on."""
    docs = np.cumsum([0, *(part.n_docs for part, _ in parts)])
    doc = np.concatenate([found.doc + first for (_, found), first in zip(parts, docs)])
    return Words(doc, *(np.concatenate([getattr(found, name) for _, found in parts]) for name in ("start", "end", "hash")), {}), int(docs[-1])


SPAN_FIELDS = ("first", "last", "first_word", "last_word")
SPAN = f"struct<{', '.join(f'{name}:long' for name in SPAN_FIELDS)}>"
HITS = f"n_words long, items array<string>, spans array<{SPAN}>"


def _search_block(docs: DataFrame, known, keep: list[str]) -> DataFrame:
    """Adds the hits of one benchmark block to ``docs``; ``known`` is its broadcast windows."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = known.value
        pending: list[tuple[pa.RecordBatch, Slice, Words]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            shard, n_docs = _joined([(part, found) for _, part, found in pending])
            count, spans, items = _spans(shard, block, n_docs)
            done = 0
            for rows, part, _ in pending:
                hits, named = [], []
                for doc in range(part.n_docs):
                    held = spans[done + doc]
                    if held:
                        text = np.frombuffer(part.text(doc), np.uint8)
                        point = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
                        base = part.offsets[doc]
                        held = [dict(zip(SPAN_FIELDS, (int(point[a - base]), int(point[b - base]), one, two))) for a, b, one, two in held]
                    hits.append(held)
                    named.append(sorted({block.names[item] for item in items[done + doc]}, key=_null_last))
                yield pa.record_batch([*(rows.column(name) for name in keep), pa.array(count[done:done + part.n_docs], pa.int64()),
                                       pa.array(named, pa.list_(pa.string())),
                                       pa.array(hits, pa.list_(pa.struct([(name, pa.int64()) for name in SPAN_FIELDS])))],
                                      [*keep, "n_words", "items", "spans"])
                done += part.n_docs
            pending.clear()

        held = 0
        for batch in batches:
            for part in slices(batch.column("text")):
                found = words(part)
                pending.append((batch.slice(part.first, part.n_docs), part, found))
                held += len(found.doc)
                if held >= SHARD_WORDS:
                    yield from flush()
                    held = 0
        if pending:
            yield from flush()
    return docs.select(*keep).mapInArrow(run, f"{fields}, {HITS}")


def _blocks(benchmark: DataFrame, windows: Windows):
    """Collects the benchmark block by block; a block holds about ``block_words`` words, and one item at least."""
    items = benchmark.select("item_id", "text").where("text is not null")
    total = items.agg(F.sum(F.regexp_count(F.lower("text"), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")))).first()[0] or 0
    blocks = -(-total // windows.block_words) or 1
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        yield phrases([row.item_id for row in rows], [row.text for row in rows], windows.size), block == blocks - 1


def find_contamination(docs: DataFrame, benchmark: DataFrame, windows: Windows = Windows(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: the ``keep`` columns and text, n_words, item ids (as sorted strings) with an occurring
    window, and the merged removal spans (code points first to last and words first_word to last_word, ends exclusive).

    A null text has no words. Items without text take no part; an item that is repeated counts once. Items without item_id are
    searched like any other and count as one item, a null at the end of the list. An
    empty benchmark or table gives no spans. Other columns of both tables are not used.
    """
    ship(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    keep_all = [*dict.fromkeys([*keep, "text"])]
    rows = None
    for known, last in _blocks(benchmark, windows):
        carried = [] if rows is None else ["items_before", "spans_before"]
        source = docs if rows is None else rows.withColumnsRenamed({"items": "items_before", "spans": "spans_before"})
        held = context.broadcast(known)
        del known
        rows = _search_block(source, held, [*keep_all, *carried])
        if carried:
            rows = rows.withColumns({"items": F.array_sort(F.array_union("items_before", "items")),
                                     "spans": F.concat("spans_before", "spans")}).drop(*carried)
        if not last:  # the next pass reads what this one has found, and its windows can go
            rows = stored(rows, "benchmark-pass")
            held.unpersist()
    return rows.withColumn("spans", merged_spans("spans")) if carried else rows


def merged_spans(name: str):
    """Spans of several passes as one sorted list without overlaps."""
    empty = f"cast(array() as array<{SPAN}>)"
    return F.expr(f"""aggregate(array_sort({name}), {empty}, (done, s) -> if(size(done) = 0 or element_at(done, -1).last < s.first,
        concat(done, array(s)), concat(slice(done, 1, size(done) - 1), array(named_struct(
            'first', element_at(done, -1).first, 'last', greatest(element_at(done, -1).last, s.last),
            'first_word', element_at(done, -1).first_word,
            'last_word', greatest(element_at(done, -1).last_word, s.last_word))))))""")


def without_passages(docs: DataFrame, benchmark: DataFrame, windows: Windows = Windows()) -> DataFrame:
    """``docs`` with every removal span cut out of the text; a document that has no word left is dropped.

    Documents without a hit are passed on unchanged, empty and null texts too. ``n_chars`` is set anew where the text changed.
    """
    # The other columns travel in one, so that none can clash with those of the search.
    packed = docs.select(F.struct(*[name for name in docs.columns if name != "text"]).alias("_row"), "text")
    found = find_contamination(packed, benchmark, windows, ("_row",))
    pieces = F.expr("""transform(sequence(0, size(spans)), i -> substring(text, if(i = 0, 1, int(spans[i - 1].last) + 1),
        if(i = size(spans), length(text), int(spans[i].first)) - if(i = 0, 0, int(spans[i - 1].last))))""")
    hit = F.size("spans") > 0
    cut = found.withColumn("text", F.when(hit, F.array_join(pieces, "")).otherwise(F.col("text")))
    cut = cut.where(~hit | F.regexp_like(F.lower("text"), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")))
    columns = {name: F.col("text") if name == "text" else F.col("_row").getField(name) for name in docs.columns}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return cut.select(*[column.alias(name) for name, column in columns.items()])
