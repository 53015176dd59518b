"""Packing documents into training sequences: vector bin packing.

A document's ids are cut into whole sequences and a rest.  A sequence has
several limits at once: tokens, segments and loss-bearing tokens.  Bins are
filled one after the other, each time with the item whose demand has the
largest dot product with the room that is left (both scaled by the limits, the
scarcer resources weighing more), until nothing fits.

Items are spread by hash over shards of about ``shard_items`` and each shard
is packed by itself, so no task sees more and the loss is one open bin per
shard.  Only narrow rows (ids' place, length, checksum) are shuffled; the ids
themselves are joined back by ``packed_sequences`` for those who want them.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed as often as they occur; a very long text is cut into whole sequences;
an empty table packs to nothing; other columns are ignored; null ids are kept.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import column_chunks
from tessera.session import materialize

#: White space other than the space and the line end.
_RARE_ASCII = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
_RARE = _RARE_ASCII + "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_PLAIN = re.compile(r"\n?\S+")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def _loose(t: str) -> bool:
    """White space that is not one space or one line end between two words."""
    return ("  " in t or "\n " in t or " \n" in t or "\n\n" in t or t[:1].isspace() or t[-1:].isspace()
            or any(c in t for c in (_RARE_ASCII if t.isascii() else _RARE)))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


#: Where a byte-level tokenizer cuts a text before it merges bytes (fixed value).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class WordIndex(dict):
    """word -> its number; a word not seen before gets the next one and is noted."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class CachedEncoder:
    """Byte-pair ids of texts, by words.

    A byte-level tokenizer never merges across a single space, or a single line
    end, between two other characters, so a text is cut there and the ids of a
    word are looked up, once for each word: under the word itself with the space
    before it, under line end and word with the line end.  New words are encoded
    by the tokenizer itself, or, where ``ranks`` names a file with the same
    vocabulary as ranks, by the merges of least rank: each entry of a trained
    vocabulary arises from its own bytes alone by the listed merges (tested for the
    given one), so both take the same merges in the same order.  Words beyond
    U+024F, where letter classes may differ between libraries, and words with a
    special token always take the tokenizer.

    The words kept are bounded by their number and their characters; beyond that
    all are forgotten before the next chunk of texts.
    """

    LIMIT = 500_000
    LIMIT_CHARS = 8_000_000

    def __init__(self, path: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.merges = None
        if ranks:
            import base64

            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.merges = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=table, special_tokens={})
        self.line_id = self.tok.encode("\n", add_special_tokens=False).ids[0]
        self.reset()

    def reset(self) -> None:
        self.index = WordIndex()
        self.chars = 0
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0
        self.start = np.zeros(1 << 14, dtype=np.int64)
        self.size = np.zeros(1 << 14, dtype=np.int64)

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, number of each text's ids)."""
        ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return (np.array([i for part in ids for i in part], dtype=np.uint32),
                np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)))

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words.  Those without inner white space go through the
        tokenizer as lines of a longer text, which is faster and gives the same
        ids; the line ends tell them apart."""
        if not all(map(_PLAIN.fullmatch, words)):
            return self._each([w if w[:1] == "\n" else " " + w for w in words])
        after_line = np.fromiter((w[0] == "\n" for w in words), dtype=bool, count=len(words))
        bare = [w[1:] if w[0] == "\n" else " " + w for w in words]
        lines = ["\n".join([*bare[i:i + 256], ""]) for i in range(0, len(bare), 256)]
        flat = np.concatenate(self._lines(lines))
        ends = np.flatnonzero(flat == self.line_id)
        sizes = np.diff(ends, prepend=-1) - 1
        flat = flat[flat != self.line_id]
        flat = np.insert(flat, (np.cumsum(sizes) - sizes)[after_line], self.line_id)
        return flat, sizes + after_line

    def _lines(self, lines: list[str]) -> list[np.ndarray]:
        """Ids of texts of many words."""
        if self.merges and all(max(t) < "\u0250" and not any(x in t for x in self.special) for t in lines):
            return [self.merges.encode_to_numpy(t, disallowed_special=()) for t in lines]
        return [np.array(e.ids, dtype=np.uint32) for e in self.tok.encode_batch_fast(lines, add_special_tokens=False)]

    def _learn(self) -> None:
        """Encode the words noted since the last call, in the order of their numbers."""
        new, self.index.new = self.index.new, []
        first = len(self.index) - len(new)
        for at in range(0, len(new), 20_480):
            some = new[at:at + 20_480]
            plain = np.fromiter((_PLAIN.fullmatch(w) is not None for w in some), dtype=bool, count=len(some))
            usual = plain & np.fromiter((max(w, default="") < "\u0250" and not any(x in w for x in self.special) for w in some),
                                        dtype=bool, count=len(some))
            for part in (usual, plain & ~usual, ~plain):
                where = np.flatnonzero(part)
                if len(where):
                    self._store(first + at + where, *self._ids([some[i] for i in where]))
        self.chars += sum(map(len, new))

    def _store(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while numbers[-1] >= len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.start[numbers] = self.used + np.cumsum(sizes) - sizes
        self.size[numbers] = sizes
        self.used += len(ids)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.index) > self.LIMIT or self.chars > self.LIMIT_CHARS:
            self.reset()
        loose = [i for i, t in enumerate(texts) if _loose(t)]
        heads = []  # loose texts: what stands before the first cut
        plain = [f"\n{t}" for t in texts]  # nothing stands before that line end
        cut = pc.split_pattern(pc.replace_substring(pa.array(plain, pa.large_string()), "\n", " \n"), " ")
        own = dict.fromkeys(loose)
        for i in loose:
            head, *own[i] = _CUT.split(texts[i])
            heads.append(head)
        counts = cut.value_lengths().to_numpy() - 1  # the empty word before the first line end
        words = cut.flatten()
        keep = np.ones(len(words), dtype=bool)
        keep[np.cumsum(counts + 1) - counts - 1] = False
        if loose:
            where = np.repeat(np.arange(len(texts)), counts + 1)
            keep &= ~np.isin(where, loose)
            counts[loose] = 0
        # each word of the chunk is looked up once, whatever its repeats
        codes = words.filter(pa.array(keep)).dictionary_encode()
        number = self._numbers(codes.dictionary.to_pylist())[codes.indices.to_numpy()]
        more = self._numbers([w for i in loose for w in own[i]])
        if self.index.new:
            self._learn()
        out = self._ids_of(number, counts)
        for i in range(len(texts)):
            out[i] = out[i][1:]  # the line end put in front
        if loose:
            ids, sizes = self._each(heads)
            rest = self._ids_of(more, np.array([len(own[i]) for i in loose]))
            for i, head, tail in zip(loose, np.split(ids, np.cumsum(sizes)[:-1]), rest):
                out[i] = np.concatenate([head, tail])
        return out

    def _numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))

    def _ids_of(self, words: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
        """Ids of texts that have ``counts`` of the numbered words each."""
        size = self.size[words]
        upto = np.concatenate([[0], np.cumsum(size)])
        flat = self.flat[np.repeat(self.start[words] - upto[:-1], size) + np.arange(upto[-1])]
        cuts = upto[np.concatenate([[0], np.cumsum(counts)])]
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


def document_pieces(docs: DataFrame, tokenizer: str | None = None, max_tokens: int = 1024, end_id: int = 0,
                    with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]), one row per piece."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    schema = ", ".join(f"{n} long" for n in names) + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One for each task: a worker that outlives it keeps none of its words.
        enc = CachedEncoder(tokenizer) if tokenizer else CachedEncoder(default_tokenizer(), default_ranks())
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for a, b, texts in column_chunks(batch.column(1)):
                rows, ids_out = [], []
                for doc_id, ids in zip(doc_ids[a:b], enc.encode([t or "" for t in texts])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for at in range(0, len(ids), max_tokens):
                        part = ids[at:at + max_tokens]
                        rows.append((doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids)))
                        if with_ids:
                            ids_out.append(part.astype(np.int32))
                cols = [pa.array(c, type=pa.int64()) for c in zip(*rows)]
                if with_ids:
                    cols.append(pa.array(ids_out, type=pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=names + ["ids"] * with_ids)

    return plain.mapInArrow(run, schema)


def fill_bins(demand: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bin, place in its bin) of each item; ``demand`` is items by resources.

    Items of equal demand are handled as one kind with a count.  Every item
    must fit an empty bin.
    """
    if not len(demand):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    kinds, kind_of = np.unique(demand, axis=0, return_inverse=True)
    kind_of = kind_of.reshape(-1)
    members = np.split(np.argsort(kind_of, kind="stable"), np.cumsum(np.bincount(kind_of))[:-1])
    next_of = np.zeros(len(kinds), dtype=np.int64)
    left = np.array([len(m) for m in members])
    share = kinds / limits
    weight = demand.sum(axis=0) / limits
    weight = weight / max(weight.max(), 1e-12)  # scarcity of each resource
    bins, place = np.zeros(len(demand), dtype=np.int64), np.zeros(len(demand), dtype=np.int64)
    current, done = 0, 0
    live = np.arange(len(kinds))
    while done < len(demand):
        room, k = limits.astype(float).copy(), 0
        live = live[left[live] > 0]
        open_ = live
        while len(open_):
            open_ = open_[(left[open_] > 0) & (kinds[open_] <= room).all(axis=1)]
            if not len(open_):
                break
            best = open_[int(np.argmax(share[open_] @ (weight * room / limits)))]
            item = members[best][next_of[best]]
            next_of[best] += 1
            left[best] -= 1
            bins[item], place[item] = current, k
            room -= kinds[best]
            k += 1
            done += 1
        current += 1
    return bins, place


def pack(pieces: DataFrame, max_tokens: int = 1024, max_segments: int = 64, max_loss: int | None = None,
         loss_col: str | None = None, shard_items: int = 4096) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``length`` (and a count
    of loss-bearing tokens, all of them if ``loss_col`` is None).

    ``pieces`` is read twice, so pass a materialised table.
    """
    shards = max(1, -(-pieces.count() // shard_items))
    key = F.pmod(F.xxhash64("doc_id", "start", "length", "ids_crc32"), F.lit(shards))
    limits = np.array([max_tokens, max_segments, max_loss or max_tokens])
    names = pieces.columns

    def run(table: pa.Table) -> pa.Table:
        # ids stay in Arrow: a null beside them makes no floats of them
        lengths = table.column("length").to_numpy()
        order = pc.sort_indices(table, sort_keys=[(c, "descending") for c in ("length", "doc_id", "start", "ids_crc32")]).to_numpy()
        table, lengths = table.take(pa.array(order)), lengths[order]
        loss = table.column(loss_col).to_numpy() if loss_col else lengths
        demand = np.column_stack([lengths, np.ones(len(lengths), dtype=np.int64), loss])
        full = int((lengths == max_tokens).sum())  # sorted first; each is a sequence of its own
        bins, place = np.arange(len(lengths)), np.zeros(len(lengths), dtype=np.int64)
        rest, place[full:] = fill_bins(demand[full:], limits)
        bins[full:] = rest + full
        order = np.lexsort([place, bins])
        upto = np.cumsum(lengths[order])
        begins = np.concatenate([[True], np.diff(bins[order]) != 0])[:len(order)]
        before = (upto - lengths[order])
        offset = np.zeros(len(order), dtype=np.int64)
        offset[order] = before - np.repeat(before[begins], np.diff(np.append(np.flatnonzero(begins), len(order))))
        shard = table.column("_shard")[0].as_py()
        return (table.select(names).append_column("sequence_id", pa.array((shard << 32) | bins))
                .append_column("offset", pa.array(offset)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return (pieces.withColumn("_shard", key).groupBy("_shard")
            .applyInArrow(run, f"{schema}, sequence_id long, offset long"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, max_tokens: int = 1024, **limits) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    pieces = materialize(document_pieces(docs, tokenizer, max_tokens))
    return pack(pieces, max_tokens, **limits)


def packed_sequences(docs: DataFrame, tokenizer: str | None = None, max_tokens: int = 1024, pad_id: int = 0,
                     **limits) -> DataFrame:
    """(sequence_id, input_ids, segment_ids, n_tokens): the padded sequences."""
    with_ids = materialize(document_pieces(docs, tokenizer, max_tokens, with_ids=True))
    placed = pack(with_ids, max_tokens, **limits)
    seq = placed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("n_tokens"))
    power = (F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1)) == 0
    pad = F.when(power, F.lit(0)).otherwise(F.lit(max_tokens) - F.col("n_tokens")).cast("int")
    return seq.select(
        "sequence_id",
        F.concat(F.flatten("parts.ids"), F.array_repeat(F.lit(pad_id), pad)).alias("input_ids"),
        F.concat(F.flatten(F.transform("parts", lambda p, i: F.array_repeat(i + 1, F.size(p["ids"])))),
                 F.array_repeat(F.lit(0), pad)).alias("segment_ids"),
        "n_tokens")
