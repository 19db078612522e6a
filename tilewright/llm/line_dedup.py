"""Line dedup by an exact set-similarity join.

A line is its set of words. Words are ordered by rarity, and two lines of Jaccard similarity t or more share one of
their first words in that order: only those prefixes are shuffled. Where many lines meet at a word, only those that share a
second one too are compared, so that pairs don't grow with the square of the input. They pass a length filter, a
positional filter and a bound on the symmetric difference from parity bits; what still hangs together is verified on
the full sets, and every line that matches an earlier one goes. No pair that reaches t can fail a filter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, hashing
from .ngram_join import by_row, shared_counts, unique_sets

#: Word frequencies are counted in so many cells. They only set the order of words, so cells may be shared.
CELLS = 1 << 17
#: Least and greatest size, as powers of two, of a filter that lets pass what a table holds and little else.
FILTER_BITS = 20, 27
#: Lines of a block: a word with more than four of them is dealt out as pairs of blocks.
BLOCK = 4096
#: A word that more lines meet at is split by their second common word.
SECOND = 128
#: Lines of more words have no second words with them, which grow with the square of a line: they meet at one word.
LONG = 256
#: Pairs compared at a time.
PAIRS = 1 << 17
#: Lines of a cluster that are verified together; a larger cluster goes in blocks of so many.
VERIFIED = 512
#: Earliest lines of a larger cluster that every block of it gets to see.
PIVOTS = 32
#: Lines of small clusters verified in one go.
TOGETHER = 64
#: Words that are dealt out as blocks, the most frequent first: any other has less than one row in so many.
SPLIT = 100_000
#: Bytes of text that are gathered before they leave for the list of losses, and that a part of it should meet.
GATHERED, PART = 16 << 20, 8 << 20
#: Bytes of rows that leave together once they have met it: bodies of large inputs have a row or two each.
TOLD = 1 << 20
#: Bytes of text whose prefixes are packed together: the fewer packs, the more rows in each, however many keys there are.
PACKED = 16 << 20
#: Pairs held until they are folded into what they connect.
PENDING = 1 << 16
LAST = (1 << 63) - 1


class Lines:
    """The distinct words of every line of some texts, and where each line stands."""

    def __init__(self, batch: pa.RecordBatch, least: int):
        ids = batch.column("doc_id").fill_null(LAST).to_numpy(zero_copy_only=False)
        texts = [t.split("\n") for t in batch.column("text").to_pylist()]
        n = np.fromiter(map(len, texts), np.int64, len(texts))
        self.size = pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
        flat = [line for lines in texts for line in lines]
        self.words, self.sizes = unique_sets(*hashing.word_hashes(flat))
        self.doc, self.line = np.repeat(ids, n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
        self.starts = np.cumsum(self.sizes) - self.sizes
        #: Lines of fewer different words than least stay out of it.
        self.rows = np.flatnonzero(self.sizes >= max(least, 1))

    def marks(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of the set of each of self.rows."""
        if not len(self.rows):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        out = []
        for k in (hashing.BASE, hashing.INVERSE):
            total = np.concatenate(([np.uint64(0)], np.cumsum(hashing.mix(self.words * np.uint64(k)), dtype=np.uint64)))
            at = self.starts[self.rows]
            out.append(hashing.mix(total[at + self.sizes[self.rows]] - total[at] + self.sizes[self.rows].astype(np.uint64)).view(np.int64))
        return out[0], out[1]


def each(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[Lines]:
    for batch in common.slices(batches, most=1 << 19):
        yield Lines(batch, least)


def first_pass(least: int):
    """mapInArrow function: place and marks of every line; then, with a cell and no place, in how many lines the words
    of each cell stand, and at the cell BYTES the size of all texts."""

    def run(batches):
        total, size = np.zeros(CELLS, np.int64), 0
        for lines in each(batches, least):
            size += lines.size
            total += np.bincount((lines.words % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
            one, two = lines.marks()
            none = pa.nulls(len(one), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(lines.doc[lines.rows]), pa.array(lines.line[lines.rows]), pa.array(one), pa.array(two), none, none], SEEN)
        cell = np.flatnonzero(total)
        none = pa.nulls(len(cell) + 1, pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array([*cell.tolist(), BYTES]), pa.array([*total[cell].tolist(), size])], SEEN)

    return run


SEEN = ["doc", "line", "id", "mark", "cell", "n"]
BYTES = -1


def prefixes(frequency, threshold: float, least: int, bits: int, hot=None, often=None, long: int = 0, count: bool = False):
    """mapInArrow function: the rare first words of each distinct line of some batches, packed by key.

    A key is a range of words (their high bits), a token names a word within it (its low bits; words that share one
    meet and fail the filters). A token of hot (sorted tokens and their numbers of blocks) has keys
    of its own instead, one for each pair of its blocks, and a line goes to those that hold its block. Lines so short
    that one word more or less takes them below the threshold match equal sets only, which marks find: they stay out.
    A token that the bit filter often lets pass has with it what may be the second common word of its line and another,
    in 16 bits each: a pair shares two of its first words and one more, if it shares two at all. 0 stands for none, in
    lines that may share one only, and in those that may match one of over long words, which have nothing else.
    With count it gives no rows but how many of them each token of a batch has, the token's key in the high bits.
    """

    def packs(held):
        ids, sizes, width, seconds, parity = (np.concatenate([x[k] for x in held]) for k in range(5))
        base = np.cumsum([0, *(len(x[0]) for x in held)])
        words, pos = (np.concatenate([x[k] for x in held]) for k in (5, 7))
        row = np.concatenate([x[6] + n for x, n in zip(held, base.tolist())])
        flat = np.concatenate([x[8] for x in held])
        key, at = (words >> np.uint64(32)).astype(np.int64), np.arange(len(words))
        crowded, wide = hot.value if hot else (np.empty(0, np.uint64), np.empty(0, np.int64))
        if len(crowded):
            found = np.minimum(np.searchsorted(crowded, words), len(crowded) - 1)
            own = np.flatnonzero(crowded[found] == words)
            blocks = wide[found[own]]
            block = (hashing.mix(ids[row[own]].view(np.uint64)) % blocks.astype(np.uint64)).astype(np.int64)
            again = np.repeat(np.arange(len(own)), blocks)
            other = np.arange(len(again)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            pair = np.minimum(block[again], other).astype(np.uint64) << np.uint64(32) | np.maximum(block[again], other).astype(np.uint64)
            special = (hashing.mix(words[own][again] ^ hashing.mix(pair)) >> np.uint64(1)).astype(np.int64) | 1 << 62
            rest = np.setdiff1d(at, own, assume_unique=True)
            key, at = np.concatenate((key[rest], special)), np.concatenate((rest, own[again]))
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        words, row, pos = words[at], row[at], pos[at]
        cuts = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)])) if len(key) else np.zeros(1, np.int64)
        last = np.cumsum(seconds)[row]
        first = np.where(sizes[row] > long, last - 1, last - seconds[row] + pos + 1)
        if often:
            first = np.where(passes(often.value, words.view(np.int64)), first, last)
            tails, tail_ends = ragged(flat, first, last - first)
        else:
            tails, tail_ends = np.empty(0, np.uint16), np.zeros(len(row) + 1, np.int64)
        bits_, ends = ragged(parity, (np.cumsum(width) - width)[row], width[row])
        # Numbers in halves: the high ones are mostly zero and take no room once compressed.
        halves = (h.astype(np.uint16) for x in (sizes[row], pos) for h in (x & 0xFFFF, x >> 16))
        fields = ((words & LOW).astype(np.uint32), ids[row], *halves, np.diff(tail_ends).astype(np.uint16))
        spans = zip(cuts.tolist(), cuts[1:].tolist(), ends[cuts[:-1]].tolist(), ends[cuts[1:]].tolist(), tail_ends[cuts[:-1]].tolist(), tail_ends[cuts[1:]].tolist())
        bodies = [np.uint32(b - a).tobytes() + b"".join(f[a:b].tobytes() for f in fields) + tails[v:w].tobytes() + bits_[t:u].tobytes() for a, b, t, u, v, w in spans]
        return pa.RecordBatch.from_arrays([pa.array(key[cuts[:-1]]), pa.array(bodies, pa.binary())], ["key", "body"])

    def run(batches):
        # Rarity in eighths of a doubling: enough for an order, and it leaves room for the word itself in a sort key.
        rarity = np.floor(8 * np.log2(np.maximum(frequency.value, 1))).astype(np.uint64)
        held, known, size = [], set(), 0
        for lines in each(batches, least):
            sizes = lines.sizes[lines.rows]
            near = sizes >= threshold * (sizes + 1) - 1e-9
            ids, first = np.unique(lines.marks()[0][near], return_index=True)
            if known:
                fresh = np.fromiter((x not in known for x in ids.tolist()), bool, len(ids))
                ids, first = ids[fresh], first[fresh]
            rows = lines.rows[near][first]
            if not len(rows):
                continue
            sizes = lines.sizes[rows]
            begin = np.cumsum(sizes) - sizes
            words, row = ragged(lines.words, lines.starts[rows], sizes)[0], np.repeat(np.arange(len(rows)), sizes)
            place = rarity[(words % np.uint64(CELLS)).astype(np.int64)] << np.uint64(55) | words >> np.uint64(9)
            words = words[by_row(row, place)]
            pos = np.arange(len(words)) - begin[row]
            shared = np.ceil(threshold * sizes - 1e-9).astype(np.int64)
            head = pos < (sizes - shared + 1)[row]
            tokens = words[head] >> np.uint64(64 - bits) << np.uint64(32) | words[head] & LOW
            if count:
                token, n = np.unique(tokens.view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(n)], ["token", "n"])
                continue
            width = 1 << parity_class(sizes)
            bit = (hashing.mix(words + np.uint64(1)) >> np.uint64(54)).astype(np.int64) & (64 * width - 1)[row]
            parity = np.zeros(width.sum(), np.uint64)
            np.bitwise_xor.at(parity, (np.cumsum(width) - width)[row] + (bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
            # Of each line the first words and one more, then 0 where it may have to meet without a second one.
            some = np.minimum(sizes - shared + 2, sizes)
            lone = (shared < 2) | (sizes >= threshold * long - 1e-9)
            seconds = some + lone
            flat = np.zeros(seconds.sum(), np.uint16)
            own = np.flatnonzero(pos < some[row])
            flat[(np.cumsum(seconds) - seconds)[row[own]] + pos[own]] = (words[own] >> np.uint64(32)) % np.uint64(0xFFFF) + np.uint64(1)
            held.append((ids, sizes, width, seconds, parity, tokens, row[head], pos[head], flat))
            known.update(ids.tolist())
            size += lines.size
            if size >= PACKED:
                yield packs(held)
                held, known, size = [], set(), 0
        if held:
            yield packs(held)

    return run


def ragged(flat: np.ndarray, first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of flat that begin at first and are so many long, end to end, and where each ends, after a 0."""
    ends = np.concatenate(([0], np.cumsum(many)))
    return flat[np.repeat(first - ends[:-1], many) + np.arange(ends[-1])], ends


PREFIX = "key long, body binary"
LOW = np.uint64(0xFFFFFFFF)


def parity_class(sizes: np.ndarray) -> np.ndarray:
    """c of the 64 * 2**c parity bits of a set: no fewer bits than words, up to 1,024."""
    return np.clip(np.ceil(np.log2(np.maximum(sizes, 1) / 64)), 0, 4).astype(np.int64)


def unpacked(bodies: list[bytes]) -> list[np.ndarray]:
    """token, id, size, pos and number of second words of all rows; those words, and the parity bits, of all end to end."""
    kinds = ("<u4", "<i8", "<u2", "<u2", "<u2", "<u2", "<u2")
    out = [[] for _ in (*kinds, "<u2", "<u8")]
    for body in bodies:
        n, at = rows_of(body), 4
        for x, kind in zip(out, kinds):
            x.append(np.frombuffer(body, kind, n, at))
            at += n * int(kind[-1])
        out[-2].append(np.frombuffer(body, "<u2", int(x[-1].sum(dtype=np.int64)), at))
        at += 2 * len(out[-2][-1])
        out[-1].append(np.frombuffer(body, "<u8", -1, at) if at < len(body) else np.empty(0, np.uint64))
    token, ids, s1, s2, p1, p2, many, tails, parity = [np.concatenate(x) for x in out]
    return [token, ids, s1 | s2.astype(np.int64) << 16, p1 | p2.astype(np.int64) << 16, many.astype(np.int64), tails, parity]


def rows_of(body: bytes) -> int:
    return int.from_bytes(body[:4], "little")


class Parity:
    """Parity bits of rows, each in its class. Two of different classes meet in the smaller: halves fold into it."""

    def __init__(self, flat: np.ndarray, begin: np.ndarray, kind: np.ndarray):
        self.kind, self.at, self.bits = kind, [], []
        for c in range(int(kind.max(initial=0)) + 1):
            rows, parts = [], []
            for k in range(c, int(kind.max(initial=0)) + 1):
                own = np.flatnonzero(kind == k)
                part = flat[begin[own, None] + np.arange(1 << k)]
                while part.shape[1] > 1 << c:
                    part = part[:, : part.shape[1] // 2] ^ part[:, part.shape[1] // 2 :]
                rows.append(own)
                parts.append(part)
            place = np.zeros(len(kind), np.int64)
            place[np.concatenate(rows)] = np.arange(sum(map(len, rows)))
            self.at.append(place)
            self.bits.append(np.concatenate(parts))

    def apart(self, left: np.ndarray, right: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which pairs have sets that surely differ in more than most words."""
        first = self.bits[0][:, 0] if len(self.at) else np.empty(0, np.uint64)
        out = np.bitwise_count(first[self.at[0][left]] ^ first[self.at[0][right]]) > most
        kind = np.where(out, 0, np.minimum(self.kind[left], self.kind[right]))
        for c in range(1, len(self.bits)):
            own = np.flatnonzero(kind == c)
            if len(own):
                differ = np.bitwise_count(self.bits[c][self.at[c][left[own]]] ^ self.bits[c][self.at[c][right[own]]]).sum(axis=1, dtype=np.int64)
                out[own] = differ > most[own]
        return out


def bit_filter(keys: DataFrame, name: str) -> np.ndarray:
    """Bits, one set for each value of the column: eight times as many as keys has rows, within FILTER_BITS. Comes to
    the driver as 64-bit words, two million at most; beyond that size more passes, and what passes is joined all the
    same."""
    size = 1 << int(np.clip(np.ceil(np.log2(8 * keys.count() + 1)), *FILTER_BITS))
    cell = F.pmod(F.col(name), F.lit(size)).cast("int")
    words = keys.select(cell.alias("cell")).groupBy(F.shiftright("cell", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cell % 64)")).alias("bits"))
    found, out = words.toArrow(), np.zeros(size // 64, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint8)


def meeting(threshold: float, second: int = SECOND):
    """mapInArrow function over rows sorted by key: ties lines that pass all filters to the smallest id they reach.

    A token of over second rows is split: its rows are compared where they share one of their second words too. Every
    pair that reaches the threshold is compared at the first two words that it has in common.
    """
    share = threshold / (1 + threshold)

    def run(batches):
        for table in common.by_key(batches):
            token, ids, size, pos, many, tails, flat = unpacked(table.column("body").to_pylist())
            kind = parity_class(size)
            begin, tail = np.cumsum(1 << kind) - (1 << kind), np.cumsum(many) - many
            # Most words stand in one prefix only. Those that, by a count in cells, stand in no other are left out.
            cell = token & np.uint32((1 << min(20, len(token).bit_length() + 3)) - 1)
            some = np.flatnonzero(np.bincount(cell)[cell] > 1)
            known, own = np.unique(ids[some], return_inverse=True)
            _, group = np.unique(token[some], return_inverse=True)
            # A line that several packs have counts once; from here on rows stand in order of size.
            once = np.unique(group * (len(known) + 1) + own, return_index=True)[1]
            once = once[np.argsort(size[some[once]], kind="stable")]
            some, own, group = some[once], own[once], group[once]
            if not len(some):
                continue
            size, many, tail = size[some], many[some], tail[some]
            rest, parity = size - pos[some], Parity(flat, begin[some], kind[some])
            stand, ahead = entries(group, np.where(np.bincount(group)[group] > second, many, 0), tail, tails, size, threshold)
            root, a, b, held = np.arange(len(known)), [], [], 0
            for x, y in spans_of(ahead):
                other = ragged(stand, np.arange(x, y) + 1, ahead[x:y])[0]
                this = np.repeat(stand[x:y], ahead[x:y])
                # What stands before the first common word is in one of the two only.
                total = size[this] + size[other]
                need = np.ceil(share * total - 1e-9)
                ok = np.flatnonzero((np.minimum(rest[this], rest[other]) >= need) & (root[own[this]] != root[own[other]]))
                this, other = this[ok], other[ok]
                ok = ~parity.apart(this, other, total[ok] - 2 * need[ok])
                a.append(own[this[ok]])
                b.append(own[other[ok]])
                held += len(a[-1])
                if held > PENDING:
                    root, a, b, held = fold(root, a, b), [], [], 0
            root = fold(root, a, b)
            moved = np.flatnonzero(root != np.arange(len(known)))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(known[moved]), pa.array(known[root[moved]])], ["a", "b"])

    return run


def entries(group: np.ndarray, many: np.ndarray, tail: np.ndarray, tails: np.ndarray, size: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order in which they are compared, and how many of those that follow each one has to meet.

    Rows are in order of size. Those with second words stand once for each of them, the others once in their group.
    """
    row_bits, group_bits = len(group).bit_length(), int(group.max()).bit_length()
    fit = np.uint64(min(16, 64 - row_bits - group_bits))
    row = np.repeat(np.arange(len(group)), np.maximum(many, 1))
    word = np.zeros(len(row), np.uint64)
    word[np.repeat(many > 0, np.maximum(many, 1))] = ragged(tails, tail, many)[0]
    meet = group[row].astype(np.uint64) << fit | word & (np.uint64(1) << fit) - np.uint64(1)
    # Most stand alone, which a count in cells shows.
    cell = (meet * np.uint64(hashing.BASE) >> np.uint64(64 - min(22, len(row).bit_length() + 2))).astype(np.int64)
    some = np.flatnonzero(np.bincount(cell)[cell] > 1)
    both = np.sort(meet[some] << np.uint64(row_bits) | row[some].astype(np.uint64))
    both = both[np.diff(both, prepend=~both[:1]) != 0]  # two second words of a row may share their 16 bits
    meet, row = both >> np.uint64(row_bits), (both & (np.uint64(1) << np.uint64(row_bits)) - np.uint64(1)).astype(np.int64)
    place = np.cumsum(np.diff(meet, prepend=meet[:1]) != 0) * (int(size[-1]) + 1)
    most = np.minimum(np.floor((size[row] + 1e-9) / threshold), size[-1]).astype(np.int64)
    return row, np.searchsorted(place + size[row], place + most, side="right") - np.arange(len(row)) - 1


def spans_of(ahead: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans of rows that have some PAIRS to meet together; a row with more is alone."""
    ends, at = np.cumsum(ahead), 0
    while at < len(ahead):
        end = int(np.searchsorted(ends, ends[at] - ahead[at] + PAIRS, side="right"))
        end = max(end, at + 1)
        yield at, end
        at = end


def fold(root: np.ndarray, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Roots after more edges."""
    return common.roots(len(root), np.concatenate([np.arange(len(root)), *a]), np.concatenate([root, *b]))


def place_mark(ids: np.ndarray, doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """One number for a line at its place."""
    return hashing.mix(ids.view(np.uint64) ^ hashing.mix(doc.view(np.uint64) ^ hashing.mix(line.astype(np.uint64)))).view(np.int64)


def place_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: adds place_mark to rows with id, doc and line."""
    for batch in batches:
        ids, doc, line = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "doc", "line"))
        yield pa.RecordBatch.from_arrays([pa.array(place_mark(ids, doc, line))], ["mark"])


def passes(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values a bit_filter lets pass."""
    cell = (values.view(np.uint64) % np.uint64(8 * len(bits))).astype(np.int64)
    return (bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)


def sets_of(filters, least: int):
    """mapInArrow function: id, place and packed set of the lines whose document and place the filters let pass."""

    def run(batches):
        some, bits = filters.value
        own = (b.filter(pa.array(passes(some, b.column("doc_id").fill_null(LAST).to_numpy(zero_copy_only=False)))) for b in batches)
        for lines in each(own, least):
            ids, doc, line = lines.marks()[0], lines.doc[lines.rows], lines.line[lines.rows]
            pick = np.flatnonzero(passes(bits, place_mark(ids, doc, line)))
            rows = lines.rows[pick]
            packed = [lines.words[s : s + n].tobytes() for s, n in zip(lines.starts[rows].tolist(), lines.sizes[rows].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(ids[pick]), pa.array(doc[pick]), pa.array(line[pick]), pa.array(packed, pa.binary())], ["id", "doc", "line", "words"])

    return run


def later(threshold: float):
    """mapInArrow function over rows sorted by key: id and place of the lines that match an earlier one of their key.

    Only lines with asks are judged, and only those with base count as the earlier ones.
    """

    def run(batches):
        for table in common.by_key(batches, least=TOGETHER):
            key, ids, doc, line, asks, base = (table.column(c).to_numpy() for c in ("key", "id", "doc", "line", "asks", "base"))
            sets = [np.frombuffer(x, np.uint64) for x in table.column("words").to_pylist()]
            both, n, gone = shared_counts(sets), np.array([*map(len, sets)], np.float64), np.zeros(len(ids), bool)
            for at in range(0, len(ids), 256):
                x = slice(at, at + 256)
                shared = both[x].astype(np.float64)
                linked = shared >= threshold * (n[x, None] + n[None] - shared) - 1e-6
                linked &= (doc[None] < doc[x, None]) | ((doc[None] == doc[x, None]) & (line[None] < line[x, None]))
                linked &= (key[x, None] == key[None]) & base[None]
                gone[x] = linked.any(axis=1) & asks[x]
            if gone.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[gone]) for x in (ids, doc, line)], PLACE)

    return run


PLACE = ["id", "doc", "line"]


def verified(sets: DataFrame, threshold: float) -> DataFrame:
    """id and place of the lines that match an earlier one of their cluster. A table of save().

    A cluster of several blocks is judged block by block first, with its earliest lines in each. Where lines are much
    alike that settles nearly all; the rest, dealt out in blocks as well, then asks every other block.
    """
    spark = sets.sparkSession
    fields = [*PLACE, "words"]
    yes, no = F.lit(True), F.lit(False)
    judged = lambda rows: rows.repartition("key").sortWithinPartitions("key").mapInArrow(common.task(later(threshold)), "id long, doc long, line long").distinct()

    block, every = F.pmod(F.xxhash64("id"), F.col("wide")), F.sequence(F.lit(0).cast("long"), F.col("wide") - 1)
    sets = sets.withColumn("block", block)
    own = sets.withColumn("to", F.explode(F.when(F.col("pivot"), every).otherwise(F.array("block"))))
    with common.small_batches(spark, 1000):
        near = common.save(judged(own.select(F.xxhash64("component", "to").alias("key"), *fields, yes.alias("asks"), yes.alias("base"))))
    large = sets.filter("wide > 1")
    open_ = common.save(large.select(*PLACE, "component").join(near, PLACE, "left_anti").distinct())
    if open_.isEmpty():
        common.discard(open_)
        return near
    counts = common.save(open_.groupBy("component").agg(F.ceil(F.count("*") / F.lit(VERIFIED)).cast("long").alias("turns")))
    turn = F.pmod(F.xxhash64("id", F.lit(5)), F.col("turns"))
    asking = large.join(open_.drop("component"), PLACE, "left_semi").join(counts, "component")
    asking = asking.withColumn("to", F.explode(every)).filter("to != block").select(F.xxhash64("component", "to", turn).alias("key"), *fields, yes.alias("asks"), no.alias("base"))
    base = large.join(counts, "component").withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)))
    base = base.select(F.xxhash64("component", "block", "turn").alias("key"), *fields, no.alias("asks"), yes.alias("base"))
    with common.small_batches(spark, 1000):
        far = common.save(judged(asking.union(base)))
    both = common.save(near.union(far))
    common.discard(open_, counts, near, far)
    return both


def removed_lines(documents: DataFrame, threshold: float = 0.8, least: int = 3) -> DataFrame:
    """doc, lines: the numbers of the lines that go, of every document that loses any. A table of save()."""
    return measured_losses(documents, threshold, least)[0]


def measured_losses(documents: DataFrame, threshold: float, least: int) -> tuple[DataFrame, int]:
    """removed_lines(), and the bytes of all texts."""
    spark = documents.sparkSession
    docs = common.texts(documents).selectExpr("cast(doc_id as long) doc_id", "text")
    seen = common.save(docs.mapInArrow(common.task(first_pass(least)), ", ".join(f"{c} long" for c in SEEN)))
    found = seen.filter("cell is not null").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # CELLS + 1 rows at most
    cell, n = (found.column(c).to_numpy() for c in ("cell", "n"))
    frequency, size = np.zeros(CELLS, np.int64), int(n[cell == BYTES].sum())
    frequency[cell[cell != BYTES]] = n[cell != BYTES]
    frequency = spark.sparkContext.broadcast(frequency)
    # Ranges grow with the input, so that what meets in one stays at some hundred thousand words.
    bits = int(np.clip(np.ceil(np.log2(max(size / (6 << 20), 1))), 4, 22))

    # Frequent words are found on a sixteenth of the documents; that only decides how rows are dealt out and split.
    part = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(16)) == 0)
    counts = part.mapInArrow(common.task(prefixes(frequency, threshold, least, bits, count=True)), "token long, n long")
    counts = common.save(counts.groupBy("token").agg((16 * F.sum("n")).alias("n")).filter(F.col("n") >= SECOND // 2))
    found = sorted((r.token, -(-r.n // BLOCK)) for r in counts.filter(F.col("n") > 4 * BLOCK).orderBy(F.desc("n"), "token").limit(SPLIT).collect())
    hot = spark.sparkContext.broadcast((np.array([t for t, _ in found], np.uint64), np.array([n for _, n in found], np.int64)))
    often = spark.sparkContext.broadcast(bit_filter(counts, "token"))
    heads = docs.mapInArrow(common.task(prefixes(frequency, threshold, least, bits, hot, often, LONG)), PREFIX).repartition("key").sortWithinPartitions("key")
    with common.small_batches(spark, 500):  # rows of some kilobytes each
        edges = common.save(heads.mapInArrow(common.task(meeting(threshold, SECOND)), "a long, b long"))
    clusters = common.components(edges)

    occ = seen.filter("cell is null").select("doc", "line", "id", "mark")
    firsts = common.save(occ.groupBy("id", "mark").agg(F.min(F.struct("doc", "line")).alias("first"), F.count("*").alias("n")))
    sizes = clusters.groupBy("component").agg(F.ceil(F.count("*") / F.lit(VERIFIED)).cast("long").alias("wide"))
    placed = clusters.join(sizes, "component").withColumnRenamed("node", "id").join(firsts.select("id", "first.doc", "first.line"), "id")
    placed = common.save(placed)
    common.discard(counts, edges, clusters)
    rank = F.row_number().over(Window.partitionBy("component").orderBy("doc", "line"))
    pivots = placed.filter("wide > 1").withColumn("rank", rank).filter(F.col("rank") <= PIVOTS).select(*PLACE, F.lit(True).alias("pivot"))
    marked = placed.mapInArrow(common.task(place_marks), "mark long")
    lined = spark.sparkContext.broadcast((bit_filter(placed, "doc"), bit_filter(marked, "mark")))
    pivoted = placed.join(pivots, PLACE, "left").withColumn("pivot", F.coalesce("pivot", F.lit(False)))
    sets = docs.mapInArrow(common.task(sets_of(lined, least)), "id long, doc long, line long, words binary")
    sets = common.save(sets.join(pivoted, PLACE))
    similar = verified(sets, threshold)

    # Of equal lines all but the first go, and that one too where it matches another earlier line.
    again = occ.join(firsts.filter("n > 1").select("id", "mark", "first"), ["id", "mark"]).filter("doc != first.doc or line != first.line")
    gone = again.select("doc", "line").union(similar.select("doc", "line"))
    gone = common.save(gone.groupBy("doc").agg(F.array_sort(F.collect_set(F.col("line").cast("int"))).alias("lines")))
    common.discard(seen, firsts, placed, sets, similar)
    for held in (frequency, hot, often, lined):
        held.unpersist()
    return gone, size


LOST = "line_dedup_removed"


def ids_of(batch: pa.RecordBatch) -> np.ndarray:
    """doc_id of each row as a number, null as LAST."""
    return batch.column("doc_id").cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)


def part_of(ids: np.ndarray, parts: int) -> np.ndarray:
    return (hashing.mix(ids.view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def touched(bits):
    """mapInArrow function: the rows whose document may lose lines, gathered and packed by part."""
    bits, parts = bits

    def run(batches):
        held, size = [], 0
        for batch in common.slices(batches):
            batch = batch.filter(pa.array(passes(bits.value, ids_of(batch))))
            held.append(batch)
            size += batch.nbytes
            if size >= GATHERED:
                yield gathered(held, parts)
                held, size = [], 0
        if held:
            yield gathered(held, parts)

    return run


def gathered(held: list[pa.RecordBatch], parts: int) -> pa.RecordBatch:
    """part, doc, lines, body: the rows of each part as one compressed body."""
    table = pa.Table.from_batches(held).combine_chunks()
    ids = ids_of(table)
    part = part_of(ids, parts)
    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)] if len(part) else [0]
    bodies, options = [], pa.ipc.IpcWriteOptions(compression="zstd")
    for a, b in zip(cuts, cuts[1:]):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
            writer.write_table(table.take(pa.array(order[a:b])))
        bodies.append(sink.getvalue().to_pybytes())
    none = pa.nulls(len(bodies), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]]), none, pa.nulls(len(bodies), pa.list_(pa.int32())), pa.array(bodies, pa.binary())], ["part", "doc", "lines", "body"])


def losses(parts: int):
    """mapInArrow function: doc and lines with their part, in the shape of gathered()."""

    def run(batches):
        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(part_of(ids, parts)), batch.column("doc"), batch.column("lines"), pa.nulls(len(ids), pa.binary())], ["part", "doc", "lines", "body"])

    return run


def without_losses(columns: list[str]):
    """mapInArrow function over rows sorted by part, its losses first: the rows of each body and what they lost.

    Only the losses of one part are held; bodies go through one by one, however many a part has.
    """

    def run(batches):
        known, at, held, size = {}, None, [], 0
        for batch in batches:
            parts, docs, lines = (batch.column(c).to_pylist() for c in ("part", "doc", "lines"))
            for i, (part, doc, gone) in enumerate(zip(parts, docs, lines)):
                if part != at:
                    known, at = {}, part
                if doc is not None:
                    known[doc] = gone
                    continue
                for rows in pa.ipc.open_stream(batch.column("body")[i].as_py()):
                    lost = [known.get(d, []) for d in ids_of(rows).tolist()]
                    texts = rows.column("text").to_pylist()
                    for k, drop in enumerate(lost):
                        if drop:
                            out = set(drop)
                            texts[k] = "\n".join([x for n, x in enumerate(texts[k].split("\n")) if n not in out])
                    own = {"text": pa.array(texts, rows.schema.field("text").type), LOST: pa.array(lost, pa.list_(pa.int32()))}
                    held.append(pa.RecordBatch.from_arrays([own[c] if c in own else rows.column(c) for c in columns], columns))
                    size += held[-1].nbytes
                    if size >= TOLD:
                        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                        held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return run


def line_dedup(documents: DataFrame, threshold: float = 0.8, least: int = 3) -> DataFrame:
    """The rows of documents, with all their columns, their text without its later matches, and line_dedup_removed.

    Lines part at line feeds; their words at white space, A-Z in lower case. A line goes when an earlier one (by
    doc_id, then place) has Jaccard similarity threshold or more with it, whether that one stays or not; lines of
    fewer than `least` different words stay as they are, and 1 leaves out none that has a word. line_dedup_removed:
    the numbers (from 0) of the lines that went, empty where none did; a column of that name in documents is replaced,
    any other name goes through. Null texts stay null, texts of any length count whole. A null doc_id comes after all
    others, and such rows, like repeated rows of a doc_id, lose the lines that any of them loses. An empty table gives
    no rows.
    """
    spark = documents.sparkSession
    documents = documents.drop(LOST)
    gone, size = measured_losses(documents, threshold, least)
    # Documents that lose nothing, as far as a filter of bounded size can tell, need not meet the list of losses.
    bits = spark.sparkContext.broadcast(bit_filter(gone, "doc"))

    @F.pandas_udf("boolean")
    def may_lose(ids: pd.Series) -> pd.Series:
        return pd.Series(passes(bits.value, ids.to_numpy()))

    whole = documents.filter(~may_lose(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)))).withColumn(LOST, F.array().cast("array<int>"))
    # The others meet it packed by part, a body for each part that a task has rows of: texts compress well together.
    parts = int(np.clip(size // PART, 16, 1 << 20))
    shape = "part long, doc long, lines array<int>, body binary"
    met = documents.mapInArrow(common.task(touched((bits, parts))), shape).union(gone.mapInArrow(common.task(losses(parts)), shape))
    met = met.repartition("part").sortWithinPartitions("part", F.col("doc").isNull())
    return whole.union(met.mapInArrow(common.task(without_losses(whole.columns)), whole.schema))


def without_repeats(documents: DataFrame, threshold: float = 0.8, least: int = 3) -> DataFrame:
    """line_dedup() with the columns of documents; a row whose words all went is dropped, others stay."""
    kept = (F.size(LOST) == 0) | F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))
    if LOST not in documents.columns:
        return line_dedup(documents, threshold, least).filter(kept).drop(LOST)
    # Their own column of that name comes through under another one.
    aside = next(c for c in (f"{LOST}_{i}" for i in range(len(documents.columns) + 1)) if c not in documents.columns)
    out = line_dedup(documents.withColumnRenamed(LOST, aside), threshold, least).filter(kept).drop(LOST)
    return out.withColumnRenamed(aside, LOST).select(*documents.columns)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_removed, removed (the numbers of the lines that went, joined by commas) and the text that stays, for
    every row."""
    out = line_dedup(common.read_table(spark, sf_dir, "documents").select("doc_id", "text"), least=1)
    return out.select("doc_id", F.size(LOST).cast("long").alias("n_removed"), F.array_join(LOST, ",").alias("removed"), "text")


#: Sets of words once each, candidates by the rarest words of each, the exact similarity of those, and the earliest line
#: that each set is equal or similar to. Built for documents whose ids are neither null nor repeated.
SQL = r"""
WITH l AS (
    SELECT doc_id, line - 1 AS line, x, list_sort(list_distinct(regexp_extract_all(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'))) AS w
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents WHERE text IS NOT NULL)
), sets AS (
    SELECT w, len(w) AS n, min(ROW(doc_id, line)) AS first, row_number() OVER () AS id FROM l WHERE len(w) > 0 GROUP BY w
), e AS (SELECT id, n, unnest(w) AS word FROM sets), f AS (SELECT word, count(*) AS often FROM e GROUP BY word
), heads AS (
    SELECT id, n, word FROM (SELECT id, n, word, row_number() OVER (PARTITION BY id ORDER BY often, word) AS place FROM e JOIN f USING (word))
    WHERE place <= n - ceil(0.8 * n - 1e-9) + 1
), met AS (
    SELECT DISTINCT a.id AS a, b.id AS b FROM heads AS a JOIN heads AS b ON a.word = b.word AND a.id <> b.id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
), alike AS (
    SELECT x.id, min(y.first) AS first FROM met JOIN sets AS x ON x.id = met.a JOIN sets AS y ON y.id = met.b
    WHERE 9 * len(list_intersect(x.w, y.w)) >= 4 * (x.n + y.n) GROUP BY x.id
), judged AS (
    SELECT l.doc_id, l.line, l.x, coalesce(ROW(l.doc_id, l.line) > least(s.first, coalesce(m.first, s.first)), FALSE) AS gone
    FROM l LEFT JOIN sets AS s USING (w) LEFT JOIN alike AS m ON m.id = s.id
)
SELECT d.doc_id, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed, coalesce(string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) FILTER (gone), '') AS removed,
    CASE WHEN d.text IS NOT NULL THEN coalesce(string_agg(x, chr(10) ORDER BY line) FILTER (NOT gone), '') END AS text
FROM documents AS d LEFT JOIN judged USING (doc_id) GROUP BY d.doc_id, d.text
"""
