"""Token ids as Huffman-coded files.

One pass encodes the texts; the ids' counts over all documents give one length-limited code, canonical,
so that the code lengths are all a reader needs. Documents are then put in ascending order of their ids
and written to one file per task: segments of about a million tokens, each with its documents' ids and
lengths, the code words, and a checkpoint (bits used) for every block of 512 tokens. Blocks are
independent, so a segment is decoded by table look-up in all its blocks at once, and any block alone.
"""

from __future__ import annotations

import functools
import json
import os
import re
import string
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import opened, slices, stored
from podium.session import scratch_dir

END_ID = 2
LIMIT = 16
BLOCK = 512
SEGMENT = 1 << 20
_REMEMBERED = 1 << 19
_FILE, _HEAD = b"HUFIDS1\n", struct.Struct("<4sIQII")
# A tokenizer's rules under which a word of plain signs falls into the pieces below.
_RULES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


@functools.cache
def _coder(path: str) -> Callable[[str | None], bytes]:
    """Text to its ids as little-endian 32-bit integers.

    The tokenizer's rules never look across white space, nor across a letter and the signs that end its
    word, and know no capitals. So the library encodes each distinct word, and each distinct run of
    closing signs, once per Python worker, and texts are put together from what is remembered. A full
    memory becomes the older one, from which words still in use come back; that bounds it at little cost.
    A text that holds an added token, such as the end mark, is encoded whole and as it is: the library
    cuts those out of the original before its other rules. One word in eight is new, and most of its cost is in the
    normalisation and splitting; a word of ASCII and Latin-1 letters is split here, and the library's model encodes its pieces.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    added = [token.content.encode().lower() for token in tokenizer.get_added_tokens_decoder().values()]
    model, symbols, plain_word = tokenizer.model, _symbols(tokenizer), _PLAIN.fullmatch

    def of_piece(piece: str) -> bytes:
        found = [token.id for token in model.tokenize(piece if piece.isascii() else piece.translate(symbols))]
        return struct.pack(f"<{len(found)}I", *found)

    def of_word(known: dict[bytes, bytes], plain: str) -> bytes:
        body = plain.rstrip(string.punctuation)
        if body != plain and body and body[-1].lower()[-1].isalpha():  # some letters end in a mark once lower-cased
            return known[body.encode()] + known[plain[len(body):].encode()]
        return np.asarray(tokenizer.encode(plain, add_special_tokens=False).ids, "<u4").tobytes()

    class Words(dict):
        older: dict = {}

        def __missing__(self, word: bytes) -> bytes:
            if len(self) >= _REMEMBERED:
                self.older = dict(self)
                self.clear()
            if (known := self.older.get(word)) is not None:
                self[word] = known
                return known
            if symbols and word.isalpha():
                found = of_piece(word.decode())
            elif symbols and plain_word(plain := word.decode()):
                pieces = _PIECES.findall(plain.lower())
                found = b"".join([self[piece.encode()] for piece in pieces]) if len(pieces) > 1 else of_piece(pieces[0])
            else:
                found = of_word(self, word.decode())
            self[word] = found
            return found

    words = Words()

    def ids_of(text: str | None) -> bytes:
        if not text:
            return b""
        lowered = text.encode().lower()
        if any(token in lowered for token in added):
            return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(words.__getitem__, lowered.split()))

    return ids_of


def _symbols(tokenizer) -> dict[int, str] | None:
    """What the model is given for a plain character; None if the tokenizer does not split words by ``_RULES``.

    Composition leaves plain characters as they are, and lower case is theirs one to one.
    """
    said = json.loads(tokenizer.to_str())
    normalizers = [step["type"] for step in (said["normalizer"] or {}).get("normalizers", ())]
    cuts = [{k: v for k, v in step.items() if k != "trim_offsets"} for step in (said["pre_tokenizer"] or {}).get("pretokenizers", ())]
    if normalizers != ["NFC", "Replace", "Lowercase"] or said["normalizer"]["normalizers"][1]["pattern"] != {"Regex": r"\s+"}:
        return None
    if cuts != [{"type": "Split", "pattern": {"Regex": _RULES}, "behavior": "Removed", "invert": True},
                {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}]:
        return None
    chars = [chr(code) for code in range(0x21, 0x100) if _PLAIN.fullmatch(chr(code))]
    cut = {ord(char): tokenizer.pre_tokenizer.pre_tokenize_str(char) for char in chars}
    symbols = {code: pieces[0][0] for code, pieces in cut.items()}
    return symbols if all(symbols[code] == chr(code) for code in symbols if code < 0x7F) else None


def forget_words() -> None:
    """Free the words a reused Python worker keeps; tasks that encode nothing call it, to have the room."""
    _coder.cache_clear()


def token_ids(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id`` and ``ids`` (packed 16-bit, 32-bit if the vocabulary needs it) of every row, the end id last.

    A null or empty text has the end id alone. The vocabulary size decides the width for all rows.
    """
    width = "<u2" if _vocabulary(tokenizer) <= 65536 else "<u4"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, last = _coder(tokenizer), np.asarray([end_id], "<u4").tobytes()
        for batch in slices(batches):
            ids = [np.frombuffer(ids_of(t) + last, "<u4").astype(width).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(encode, "doc_id bigint, ids binary")


@functools.cache
def _vocabulary(path: str) -> int:
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path).get_vocab_size()


def id_counts(ids: DataFrame, vocabulary: int) -> DataFrame:
    """``id``, ``n`` over all documents; every task adds up its own first."""
    width = "<u2" if vocabulary <= 65536 else "<u4"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        total = np.zeros(vocabulary, np.int64)
        for batch in slices(batches):
            for doc in batch.column(0):
                total += np.bincount(np.frombuffer(doc.as_buffer(), width), minlength=vocabulary)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["id", "n"])

    return (ids.select("ids").mapInArrow(count, "id bigint, n bigint")
            .groupBy("id").agg(F.sum("n").cast("bigint").alias("n")))


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code without words above ``limit`` bits, by package-merge.

    Level by level, symbols are merged in order of weight with the pairs of the level before; walking
    back from the 2n - 2 cheapest entries of the last level, a symbol's length is the number of levels
    in which it is among the chosen.
    """
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit words of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    levels, merged = [], weights
    levels.append(np.ones(len(weights), bool))
    for _ in range(limit - 1):
        pairs = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        place = np.argsort(both, kind="stable")
        merged = both[place]
        levels.append(place < len(weights))
    chosen, depth = 2 * len(weights) - 2, np.zeros(len(weights), np.uint8)
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:chosen].sum())
        depth[:symbols] += 1
        chosen = 2 * (chosen - symbols)
    lengths[order] = depth
    return lengths


def code_words(lengths: np.ndarray) -> np.ndarray:
    """Canonical words: in order of length, then id, each one more than the one before, widened."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    top = int(lengths.max(initial=1))
    steps = np.left_shift(np.uint64(1), (top - lengths[order]).astype(np.uint64))
    starts = np.concatenate([[np.uint64(0)], np.cumsum(steps, dtype=np.uint64)[:-1]]) if len(order) else steps
    words = np.zeros(len(lengths), np.uint32)
    words[order] = (starts >> (top - lengths[order]).astype(np.uint64)).astype(np.uint32)
    return words


def pack(ids: np.ndarray, words: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bits of all ids in order, and the bits that each block of 512 uses."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    cell, room = starts >> 5, (64 - (starts & 31) - size).astype(np.uint64)
    shifted = words[ids].astype(np.uint64) << room  # within a 64-bit window that begins at the cell
    bits = np.zeros(int(ends[-1] >> 5) + 2, np.uint64)
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    sums = np.add.reduceat(shifted, first)  # words do not overlap, so adding is joining
    bits[cell[first]] += sums >> np.uint64(32)
    bits[cell[first] + 1] += sums & np.uint64(0xFFFFFFFF)
    data = bits.astype(">u4").tobytes()[:(int(ends[-1]) + 7) // 8]
    return data, np.add.reduceat(size, np.arange(0, len(ids), BLOCK)).astype("<u2")


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For every window of the longest word's bits: the id it starts with, and that word's length."""
    top = int(lengths.max(initial=1))
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    times = np.left_shift(1, top - lengths[order].astype(np.int64))
    ids, sizes = np.zeros(1 << top, np.uint32), np.ones(1 << top, np.int64)
    filled = int(times.sum())
    ids[:filled], sizes[:filled] = np.repeat(order, times), np.repeat(lengths[order], times)
    return ids, sizes, top


def unpack(data: bytes, block_bits: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """Ids of a segment: all its blocks step through their words side by side."""
    ids_of, size_of, top = table
    raw = np.frombuffer(data + b"\0" * 8, np.uint8).astype(np.uint64)
    window = (raw[:-3] << np.uint64(24)) | (raw[1:-2] << np.uint64(16)) | (raw[2:-1] << np.uint64(8)) | raw[3:]
    at = np.concatenate([[0], np.cumsum(block_bits.astype(np.int64))[:-1]])
    out = np.zeros((len(block_bits), BLOCK), np.uint32)
    last = n - (len(block_bits) - 1) * BLOCK
    mask = np.uint64((1 << top) - 1)
    for step in range(min(BLOCK, n)):
        live = len(at) if step < last else len(at) - 1
        here = at[:live]
        code = (window[here >> 3] >> (32 - top - (here & 7)).astype(np.uint64)) & mask
        out[:live, step] = ids_of[code]
        at[:live] = here + size_of[code]
    return out.reshape(-1)[:n]


def segment(docs: list[tuple[int | None, np.ndarray]], words: np.ndarray, lengths: np.ndarray) -> bytes:
    ids = np.concatenate([d for _, d in docs])
    data, block_bits = pack(ids, words, lengths)
    names = np.array([0 if i is None else i for i, _ in docs], "<i8")
    nulls = np.array([i is None for i, _ in docs], np.uint8)
    sizes = np.array([len(d) for _, d in docs], "<u8")
    head = _HEAD.pack(b"SEG\n", len(docs), len(ids), len(block_bits), len(data))
    return b"".join([head, names.tobytes(), nulls.tobytes(), sizes.tobytes(), block_bits.tobytes(), data])


def segments(stream) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes, int]]:
    """Ids, null marks, lengths, checkpoints, bits and number of tokens of a file's segments, one by one."""
    if stream.read(len(_FILE)) != _FILE:
        raise ValueError("not a file of token ids")
    while head := stream.read(_HEAD.size):
        mark, n_docs, n_tokens, n_blocks, n_bytes = _HEAD.unpack(head)
        if mark != b"SEG\n":
            raise ValueError("damaged segment")
        parts = [stream.read(n) for n in (8 * n_docs, n_docs, 8 * n_docs, 2 * n_blocks, n_bytes)]
        yield (np.frombuffer(parts[0], "<i8"), np.frombuffer(parts[1], np.uint8), np.frombuffer(parts[2], "<u8"),
               np.frombuffer(parts[3], "<u2"), parts[4], n_tokens)


def write_codebook(folder: str, lengths: np.ndarray) -> None:
    """The code, as one byte per id: its word's length."""
    system, root = opened(folder)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/codebook.bin") as stream:
        stream.write(lengths.astype(np.uint8).tobytes())


def read_codebook(folder: str) -> np.ndarray:
    system, root = opened(folder)
    with system.open_input_file(f"{root}/codebook.bin") as stream:
        return np.frombuffer(stream.read(), np.uint8)


def write_ids(ids: DataFrame, folder: str, lengths: np.ndarray, width: str) -> DataFrame:
    """Write the files, in ascending ``doc_id`` order (nulls first), and return a row for each.

    A task writes under a name of its attempt and moves the whole file into place at its end, so a
    repeated task leaves the same file.
    """
    words = code_words(lengths)
    write_codebook(folder, lengths)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        forget_words()
        system, root = opened(folder)
        part, draft, stream, tokens, held, size = TaskContext.get().partitionId(), None, None, 0, [], 0
        for batch in slices(batches):
            for doc_id, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                if stream is None:
                    draft = f"{root}/.draft-{part:05d}-{uuid.uuid4().hex}"
                    stream = system.open_output_stream(draft)
                    stream.write(_FILE)
                doc = np.frombuffer(packed.as_buffer(), width)
                held.append((doc_id, doc.copy()))
                size, tokens = size + len(doc), tokens + len(doc)
                if size >= SEGMENT:
                    stream.write(segment(held, words, lengths))
                    held, size = [], 0
        if stream is not None:
            if held:
                stream.write(segment(held, words, lengths))
            stream.close()
            name = f"part-{part:05d}.huf"
            system.move(draft, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([tokens], pa.int64())],
                                             ["part", "name", "tokens"])

    ordered = (ids.withColumn("tie", F.xxhash64("ids")).repartitionByRange("doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie").select("doc_id", "ids"))
    return stored(ordered.mapInArrow(write, "part int, name string, tokens bigint"), "id-files")


def read_ids(files: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    One row per file meets in one task to add up where each file starts.
    """
    before = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("bigint"))
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        system, root = opened(folder)
        table = decode_table(read_codebook(folder))
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_file(f"{root}/{name}") as stream:
                    for names, nulls, sizes, block_bits, data, n in segments(stream):
                        ids = unpack(data, block_bits, n, table)
                        ends = np.cumsum(sizes.astype(np.int64))
                        begins = ends - sizes.astype(np.int64)
                        crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(begins, ends)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(names, pa.int64(), mask=nulls.astype(bool)), pa.array(start + begins),
                             pa.array(ends - begins), pa.array(crc, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += n

    n_files = max(1, files.count())
    return starts.select("name", "start").repartition(n_files, "name").mapInArrow(read, schema)


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int = END_ID, limit: int = LIMIT) -> DataFrame:
    """Encode all rows of ``docs``, write the files, read them back.

    Null and empty texts are documents of the end id alone; repeated ids follow one another in the
    order of a digest of their ids; an empty table gives no files and no rows; extra columns are not
    read. What reaches the driver is bounded by the vocabulary: a count and a code length per id.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "token-files")
    vocabulary = max(_vocabulary(tokenizer), end_id + 1)
    ids = stored(token_ids(docs, tokenizer, end_id), "token-ids")
    counts = np.zeros(vocabulary, np.int64)
    for row in id_counts(ids, vocabulary).collect():
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts, max(limit, (vocabulary - 1).bit_length()))
    files = write_ids(ids, folder, lengths, "<u2" if vocabulary <= 65536 else "<u4")
    return read_ids(files, folder)
