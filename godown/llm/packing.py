"""Best-fit packing in bulk-synchronous steps (operator 5).

Token counts lie between 1 and the capacity, so equal lengths and equal gaps
form runs, and at most ``capacity`` runs exist whatever the number of rows.
Spark sorts the pieces by length and ranks them inside their length; the
sweep goes over the runs, longest first: a step matches a run of pieces with
its successor, the smallest gap that holds them, rank decides which piece
takes which sequence (the k-th free piece the k-th open sequence), the gaps
are updated, and the step repeats until the run is placed.  What the sweep
yields is a list of rank intervals; Spark places every row by its rank.
Equal lengths are interchangeable, so the result is that of best-fit
decreasing row by row, without a shuffle per step.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from godown.llm.common import out_batch, slices, written

#: Parts of words that a task remembers, and their characters; longer ones are encoded each time.
TABLE_ROWS, TABLE_CHARS, LONG = 600_000, 16_000_000, 1_000
#: Parts that the library merges in one call: so many, of so many characters.
CALL_ROWS, CALL_CHARS = 5_000, 200_000
#: Rows that share a rank window, about.
RANK_ROWS = 5_000
LENGTH_DIGITS = 1 << 40


#: How the vocabulary file normalises and splits words.  A file with other settings gets no short cut.
NORMALIZER = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts of these characters need no composition and are lower-cased and split the same way by ``re``.
PLAIN = re.compile(r"[\x20-\x7e\n\xc0-\xd6\xd8-\xf6\xf8-\xff]*+")
PLAIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]++|[0-9]|[^\sa-z0-9\xdf-\xf6\xf8-\xff]++")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for letters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def cut_ids(enc, n: int, at) -> list[bytes]:
    """The ids of an encoding as bytes, cut into n parts; ``at``: the part of each token."""
    raw = np.asarray(enc.ids, dtype="<u4").tobytes()
    cut = (np.searchsorted(at, np.arange(n + 1)) * 4).tolist()
    return [raw[a:b] for a, b in zip(cut, cut[1:])]


def calls(items: list[str]):
    """``items`` in lists for one call of the library each."""
    some, chars = [], 0
    for x in items:
        if some and (len(some) >= CALL_ROWS or chars + len(x) > CALL_CHARS):
            yield some
            some, chars = [], 0
        some.append(x)
        chars += len(x)
    if some:
        yield some


class Memo(dict):
    """A dict that starts over when it holds too much; a text's entries are asked for right after they are set."""

    chars = 0

    def room(self, items) -> None:
        more = sum(map(len, items))
        if len(self) + len(items) > TABLE_ROWS or self.chars + more > TABLE_CHARS:
            self.clear()
            self.chars = 0
        self.chars += more


def text_encoder(tokenizer_file: str):
    """texts -> [ids of each as little-endian uint32 bytes]; a worker loads a file once and its tasks share what it remembers."""
    at = os.stat(tokenizer_file)
    return loaded_encoder(tokenizer_file, at.st_mtime_ns, at.st_size)


@functools.lru_cache(maxsize=1)
def loaded_encoder(tokenizer_file: str, *changed: int):
    """The encoder of a file as it is now.

    A plain text is lower-cased and split here as a whole, and each distinct
    part is merged once by the library's model and remembered.  In other
    texts that holds for the plain words; the rest goes through the whole
    tokenizer word by word.
    """
    from tokenizers import Tokenizer

    with open(tokenizer_file, encoding="utf-8") as f:
        spec = json.load(f)
    tok = Tokenizer.from_file(tokenizer_file)
    steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
    splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    short_cut = steps == NORMALIZER and splits[0].get("pattern") == {"Regex": SPLIT} and splits[-1].get("type") == "ByteLevel"
    bare = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}))
    special = [t["content"] for t in spec["added_tokens"]]
    letters = byte_letters()
    parts, words = Memo(), Memo()

    def plain(t: str) -> bool:
        return short_cut and PLAIN.fullmatch(t) is not None and not any(x in t for x in special)

    def merged(some: list[str]) -> list[bytes]:
        enc = bare.encode(" ".join([p.encode().decode("latin-1").translate(letters) for p in some]), add_special_tokens=False)
        return cut_ids(enc, len(some), np.asarray(enc.word_ids))

    def whole(some: list[str]) -> list[bytes]:
        enc = tok.encode("\n".join(some), add_special_tokens=False)
        at = np.fromiter((o[0] for o in enc.offsets), dtype=np.int64, count=len(enc.ids))
        return cut_ids(enc, len(some), np.searchsorted(np.cumsum([len(w) + 1 for w in some]), at, side="right"))

    def known(memo: Memo, wanted: set, encode) -> Memo | dict:
        """Every one of ``wanted`` with its ids; those worth it are remembered."""
        fresh = [x for x in wanted if x not in memo]
        short, long = [x for x in fresh if len(x) <= LONG], [x for x in fresh if len(x) > LONG]
        held = len(memo)
        memo.room(short)
        if held and not memo:                      # started over
            short = [x for x in wanted if len(x) <= LONG]
        for some in calls(short):
            memo.update(zip(some, encode(some)))
        return memo if not long else memo | {x: ids for some in calls(long) for x, ids in zip(some, encode(some))}

    def ids_of(texts: list[str]) -> list[bytes]:
        easy = [plain(t) for t in texts]
        split = [PLAIN_SPLIT.findall(t.lower()) if e else [w for w in t.replace("\n", " ").split(" ") if w]
                 for t, e in zip(texts, easy)]
        odd = {w: PLAIN_SPLIT.findall(w.lower()) if plain(w) else None for w in set().union(*(s for s, e in zip(split, easy) if not e))}
        table = known(parts, set().union(*(s for s, e in zip(split, easy) if e), *(p for p in odd.values() if p)), merged)
        hard = known(words, {w for w, p in odd.items() if p is None}, whole)
        word = {w: hard[w] if p is None else b"".join([table[x] for x in p]) for w, p in odd.items()}
        return [b"".join(map((table if e else word).__getitem__, s)) for s, e in zip(split, easy)]

    return ids_of


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int, end_id: int,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document.

    White space is dropped by the tokenizer, so the parts of words are
    encoded on their own, each distinct part once per worker while it is remembered.
    """
    def run(batches):
        ids_of = text_encoder(tokenizer_file)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        step = 4 * capacity
        for b in slices(batches):
            row, piece, length, crc = [], [], [], []
            for k, raw in enumerate(ids_of([t or "" for t in b.column(1).to_pylist()])):
                raw += end
                for p, a in enumerate(range(0, len(raw), step)):
                    part = raw[a:a + step]
                    row.append(k)
                    piece.append(p)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            piece = np.asarray(piece, dtype=np.int32)
            yield out_batch(["doc_id", "piece", "start", "length", "ids_crc32"],
                            [b.column(0).take(pa.array(row, pa.int64())), piece, piece.astype(np.int64) * capacity,
                             pa.array(length, pa.int64()), pa.array(crc, pa.int64())])

    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


class Gaps:
    """Open sequences in runs of equal gap: gap -> [(first sequence, how many)], smallest gap above a size at once."""

    def __init__(self, capacity: int):
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.open = 0                     # bit g: a run with gap g exists

    def successor(self, size: int) -> int | None:
        above = self.open >> size
        return size + (above & -above).bit_length() - 1 if above else None

    def add(self, gap: int, first: int, count: int) -> None:
        if gap > 0 and count > 0:
            self.runs[gap].append((first, count))
            self.open |= 1 << gap

    def take(self, gap: int) -> tuple[int, int]:
        run = self.runs[gap].pop()
        if not self.runs[gap]:
            self.open &= ~(1 << gap)
        return run


def sweep(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rank intervals for ``counts`` (length -> pieces): rows (length, rank, per, sequence, offset).

    Ranks from ``rank`` to the next interval of the length: piece number r
    goes to sequence ``sequence + (r - rank) // per`` at offset
    ``offset + (r - rank) % per * length``.  ``per`` is how many pieces of
    this length fill one gap, so equal pieces go on filling the sequence they
    opened, as best fit has it.
    """
    gaps, out, free = Gaps(capacity), [], 0
    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        while left:
            gap = gaps.successor(size)
            if gap is None:
                gap, first, have = capacity, free, -(-left // (capacity // size))
                free += have
            else:
                first, have = gaps.take(gap)
            per = gap // size
            full = min(have, left // per)
            out.append((size, rank, per, first, capacity - gap))
            rest = left - full * per
            gaps.add(gap - per * size, first, full)
            used = full
            if full < have and rest:      # fewer pieces than one whole gap takes: rest < per
                gaps.add(gap - rest * size, first + full, 1)
                used, rest = full + 1, 0
            gaps.add(gap, first + used, have - used)
            rank += left - rest
            left = rest
    return np.array(out, dtype=np.int64).reshape(-1, 5)


def ranked(parts: DataFrame, total: int) -> DataFrame:
    """``rank`` of each row inside its length, from 0: windows over (length, salt), then the salts' offsets."""
    salts = max(1, min(1 << 20, total // RANK_ROWS))
    rows = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    inner = rows.withColumn("r", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1)
    sizes = rows.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    return (inner.join(sizes.select("length", "salt", before.alias("before")), ["length", "salt"])
            .withColumn("rank", F.col("before") + F.col("r")).drop("salt", "r", "before"))


def pack(parts: DataFrame, capacity: int) -> DataFrame:
    """``parts`` (doc_id, piece, length between 1 and capacity, more) with sequence_id and offset."""
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    plan = sweep(counts, capacity)
    order = np.lexsort((plan[:, 1], plan[:, 0]))
    plan = plan[order]

    def place(batches):
        keys = plan[:, 0] * LENGTH_DIGITS + plan[:, 1]
        for b in batches:
            length = b.column(b.schema.get_field_index("length")).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = b.column(b.schema.get_field_index("rank")).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(keys, length * LENGTH_DIGITS + rank, side="right") - 1
            _, first, per, seq, offset = (plan[at, i] for i in range(5))
            k = rank - first
            keep = [i for i, n in enumerate(b.schema.names) if n != "rank"]
            yield out_batch([b.schema.names[i] for i in keep] + ["sequence_id", "offset"],
                            [b.column(i) for i in keep] + [seq + k // per, offset + k % per * length])

    rows = ranked(parts, sum(counts.values())).select(*parts.columns, "rank")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "rank")
    return rows.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = 4096, end_id: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    Null and empty text is the end id alone.  Only documents longer than
    ``capacity`` tokens are cut.  Repeated rows are packed once each; an
    empty table gives an empty result; extra columns don't matter.
    """
    return pack(written(pieces(docs, tokenizer_file, capacity, end_id, id_col, text_col), "pack_pieces"), capacity)
