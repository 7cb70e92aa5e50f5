"""Saved queries counted in cells: one span of entities and one chunk of queries at a time.

Entities times queries that match is a number that grows with the square of the table, so no such
pair is ever a row. Entities keep what they hold of the words, phrases and facts that queries ask
for. A cell reads its queries, then its entities in strips; each strip makes one row of bits per
condition that it holds, and ands the rows that each query names.

Words and facts are 64-bit hashes, phrases the hashes of their words joined in order. On the way
to the cells what queries ask for most is known by small numbers, seven bits to a byte.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

#: Entities whose bits are worked on at once, and queries.
WIDTH = 2048
SLICE = 4096
#: Bytes of one strip's bits; a strip that would take more is halved.
STRIP_BYTES = 64 * 1024 * 1024
#: Words that are looked up at once, and queries or conditions that travel as one row.
WORDS = 500_000
PACK = 2048

HASHED = "chunk int, ask long, must array<long>, never array<long>"
PACKED = "chunk int, asks binary, must binary, must_sizes binary, never binary, never_sizes binary, rest array<long>"
HELD = "key long, chunk int, common binary, rare array<long>"
FOUND = "ask long, n long"
_LONGS = pa.list_(pa.int64())
_HASHED = pa.schema([("chunk", pa.int32()), ("ask", pa.int64()), ("must", _LONGS), ("never", _LONGS)])
_PACKED = pa.schema(
    [("chunk", pa.int32()), *[(x, pa.binary()) for x in ("asks", "must", "must_sizes", "never", "never_sizes")], ("rest", _LONGS)]
)
_HELD = pa.schema([("key", pa.int64()), ("chunk", pa.int32()), ("common", pa.binary()), ("rare", _LONGS)])
_FOUND = pa.schema([("ask", pa.int64()), ("n", pa.int64())])


def _joined(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of runs of words with one more word each."""
    x = before * np.uint64(0x9E3779B97F4A7C15) + word
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ends(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The elements end to end, and how many each list has."""
    return lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(_ends(sizes).astype(np.int32)), pa.array(values))


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of stretches that begin at ``starts``, end to end."""
    return np.repeat(starts - _ends(sizes)[:-1], sizes) + np.arange(sizes.sum())


def _short(numbers: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """``sizes`` numbers a row as bytes: seven bits each, the eighth where more follow."""
    numbers = numbers.astype(np.uint64)
    length = np.ones(len(numbers), np.int64)
    for k in range(1, 10):
        length += numbers >= np.uint64(1 << 7 * k)
    at = _ends(length)
    data = np.empty(at[-1], np.uint8)
    for k in range(int(length.max(initial=0))):
        which = np.flatnonzero(length > k)
        seven = ((numbers[which] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8)
        data[at[which] + k] = seven | ((length[which] > k + 1).astype(np.uint8) << 7)
    offsets = at[_ends(sizes)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _numbers(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """What ``_short`` was made of: the numbers end to end, and how many each row has."""
    rows = rows.cast(pa.binary())
    offsets = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset : rows.offset + len(rows) + 1]
    data = np.frombuffer(rows.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    last = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    length = last - starts + 1
    numbers = np.zeros(len(last), np.uint64)
    for k in range(int(length.max(initial=0))):
        which = np.flatnonzero(length > k)
        numbers[which] |= (data[starts[which] + k] & 127).astype(np.uint64) << np.uint64(7 * k)
    return numbers.astype(np.int64), np.diff(np.searchsorted(last, offsets - offsets[0]))


def _gaps(numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The first number of each row, and what each of the others adds to the one before."""
    gaps = np.diff(numbers, prepend=0)
    starts = _ends(sizes)[:-1][sizes > 0]
    gaps[starts] = numbers[starts]
    return gaps


def _summed(gaps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.cumsum(gaps)
    starts = _ends(sizes)[:-1]
    return total - np.repeat(np.concatenate([[0], total])[starts], sizes)


class Known:
    """Hashes by their places in a list, those that most queries ask for first."""

    def __init__(self, hashes: np.ndarray, every: bool) -> None:
        #: ``every``: nothing else is asked for.
        self.hashes, self.every = hashes, every

    @cached_property
    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(self.hashes)
        return self.hashes[order], order

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """Each hash's place; -1 for others."""
        ordered, order = self._sorted
        if not len(order):
            return np.full(len(hashes), -1)
        place = order[np.minimum(np.searchsorted(ordered, hashes), len(order) - 1)]
        return np.where(self.hashes[place] == hashes, place, -1)


def _hash(conditions: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """One hash per condition, which comes as the hashes of its words, and conditions per row."""
    lists = conditions.flatten()
    words, lengths = _flat(lists)
    words, starts = words.view(np.uint64), _ends(lengths)[:-1]
    hashes = words[starts] if len(starts) else words[:0]
    for i in range(1, int(lengths.max(initial=0))):
        longer = np.flatnonzero(lengths > i)
        hashes[longer] = _joined(hashes[longer], words[starts[longer] + i])
    return hashes, conditions.value_lengths().to_numpy(zero_copy_only=False)


def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``chunk, ask, must, never`` with the words of each condition, to ``HASHED``."""
    for batch in batches:
        sides = []
        for name in ("must", "never"):
            hashes, sizes = _hash(batch.column(name))
            sides.append(_lists(hashes.view(np.int64), sizes))
        yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("ask"), *sides], schema=_HASHED)


def packs(known: Known) -> Callable:
    """``HASHED`` to ``PACKED``: queries of one chunk as few rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk, ask = (batch.column(name).to_numpy() for name in ("chunk", "ask"))
            sides = [_flat(batch.column(name)) for name in ("must", "never")]
            sides = [(values.view(np.uint64), sizes) for values, sizes in sides]
            order = np.lexsort((ask, chunk))
            weight = np.cumsum(np.maximum(sides[0][1] + sides[1][1], 1)[order]) // PACK
            cuts = np.flatnonzero(np.diff(chunk[order]) | (np.diff(weight) > 0)) + 1
            places = [known.place(values) for values, _ in sides]
            for rows in np.split(order, cuts) if len(order) else []:
                one = lambda numbers: _short(numbers, np.array([len(numbers)]))
                out = [pa.array(chunk[rows[:1]]), one(_gaps(ask[rows], np.array([len(rows)])))]
                rest = []
                for (values, sizes), place in zip(sides, places, strict=True):
                    at = _ragged(_ends(sizes)[:-1][rows], sizes[rows])
                    out += [one(place[at] + 1), one(sizes[rows])]
                    rest.append(values[at][place[at] < 0])
                rest = np.concatenate(rest).view(np.int64)
                yield pa.RecordBatch.from_arrays([*out, _lists(rest, np.array([len(rest)]))], schema=_PACKED)

    return run


def _unpacked(rows: pa.RecordBatch, known: Known) -> dict[str, np.ndarray]:
    """Queries of some rows of ``PACKED``: asks, hashes and numbers of hashes."""
    column = {name: _numbers(rows.column(name)) for name in _PACKED.names[1:-1]}
    rest, _ = _flat(rows.column("rest"))
    must, never = column["must"], column["never"]
    # In ``rest`` each row has its required hashes first, then the others.
    side = np.concatenate([np.repeat(np.arange(len(rows_of)) * 2 + i, rows_of) for i, (_, rows_of) in enumerate((must, never))])
    place = np.concatenate([must[0], never[0]]) - 1
    hashes = np.zeros(len(place), np.uint64)
    hashes[place >= 0] = known.hashes[place[place >= 0]]
    unknown = np.flatnonzero(place < 0)
    hashes[unknown[np.argsort(side[unknown], kind="stable")]] = rest.view(np.uint64)
    return {
        "asks": _summed(*column["asks"]),
        "must": hashes[: len(must[0])],
        "must_sizes": column["must_sizes"][0],
        "never": hashes[len(must[0]) :],
        "never_sizes": column["never_sizes"][0],
    }


def _runs(words: np.ndarray, entity: np.ndarray, lengths: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of all runs of so many words, and whose they are; ``words`` are those of one entity after the other."""
    runs, many = words, len(words)
    for n in range(1, max(lengths, default=0) + 1):
        if n > 1:
            many -= 1
            runs = _joined(runs[:many], words[n - 1 :])
        inside = np.flatnonzero(entity[:many] == entity[n - 1 :])
        if not len(inside):
            return
        if n in lengths:
            yield runs[inside], entity[inside]


def holdings(lengths: list[int], known: Known, bits: dict[int, np.ndarray]) -> Callable:
    """``key, words, facts`` to ``HELD``: what an entity holds of the conditions of each chunk of queries.

    ``bits`` of a chunk tell by a hash's last bits whether some query may ask for it. What passes by
    chance meets no query in a cell.
    """

    def asked(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
        at = values & np.uint64(len(bits) * 8 - 1)
        return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = np.arange(batch.num_rows)
        words, sizes = _flat(batch.column("words"))
        facts, n_facts = _flat(batch.column("facts"))
        found = [(facts.view(np.uint64), np.repeat(rows, n_facts)), *_runs(words.view(np.uint64), np.repeat(rows, sizes), lengths)]
        values, owners = (np.concatenate(parts) for parts in zip(*found, strict=True))
        kept = np.zeros(len(values), bool)
        for one in bits.values():
            kept |= asked(values, one)
        names, place = np.unique(values[kept], return_inverse=True)
        if not len(names):
            return
        owners, place = np.divmod(np.unique(owners[kept] * len(names) + place), len(names))
        number = known.place(names)
        # By number, those without one last.
        order = np.argsort(owners * (len(known.hashes) + 1) + np.where(number < 0, len(known.hashes), number)[place])
        owners, place = owners[order], place[order]
        often = number >= 0
        count = lambda part: np.bincount(owners[part], minlength=len(rows))
        for chunk, one in bits.items():
            wanted = asked(names, one) & (often | (not known.every))
            has = np.flatnonzero(count(wanted[place]))
            many, few = (wanted & often)[place], (wanted & ~often)[place]
            sizes = count(many)[has]
            keys = pa.array(batch.column("key").to_numpy()[has])
            chunks = pa.array(np.full(len(has), chunk, np.int32))
            common = _short(_gaps(number[place[many]], sizes), sizes)
            rare = _lists(names[place[few]].view(np.int64), count(few)[has])
            yield pa.RecordBatch.from_arrays([keys, chunks, common, rare], schema=_HELD)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = _ends(batch.column("words").value_lengths().to_numpy(zero_copy_only=False))
            low = 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(total, total[low] + WORDS, side="right")) - 1)
                yield from some(batch.slice(low, high - low))
                low = high

    return run


class _Entities:
    """Entities in the order of their ids' hashes, and the atoms of each end to end."""

    def __init__(self, keys: np.ndarray, sizes: np.ndarray, atoms: np.ndarray) -> None:
        self.keys, self.sizes, self.atoms, self.ends = keys, sizes, atoms, _ends(sizes)

    def taken(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[rows]
        return np.repeat(np.arange(len(rows)), sizes), self.atoms[_ragged(self.ends[rows], sizes)]

    def part(self, low: int, high: int) -> _Entities:
        return _Entities(self.keys[low:high], self.sizes[low:high], self.atoms[self.ends[low] : self.ends[high]])

    def with_more(self, more: _Entities) -> _Entities:
        both = ((self.keys, more.keys), (self.sizes, more.sizes), (self.atoms, more.atoms))
        return _Entities(*[np.concatenate(pair) for pair in both])


class _Chunk:
    """The queries of a cell, and what is counted so far."""

    def __init__(self, packed: list[dict[str, np.ndarray]], known: Known) -> None:
        parts = {name: np.concatenate([p.pop(name) for p in packed]) for name in [*packed[0]]}
        asks, must_sizes, never_sizes = (parts.pop(name) for name in ("asks", "must_sizes", "never_sizes"))
        order = np.argsort(asks, kind="stable")
        self.asks, code, ways = np.unique(asks[order], return_inverse=True, return_counts=True)
        first_never = len(parts["must"])
        hashes = np.concatenate([parts.pop("must"), parts.pop("never")]).view(np.uint64)
        self.atoms, place, asked = np.unique(hashes, return_inverse=True, return_counts=True)
        del hashes
        self.place = place = place.astype(np.int32)
        #: The row of bits that an atom has in a strip; 0 is the row without any. The last atom stands for no condition.
        self.slot = np.zeros(len(self.atoms) + 1, np.int32)
        at = np.minimum(np.searchsorted(self.atoms, known.hashes), len(self.atoms) - 1)
        self.common = np.where(self.atoms[at] == known.hashes, at, -1)
        starts, sizes = _ends(must_sizes)[:-1][order], must_sizes[order]
        self.off, self.n_off = _ends(never_sizes)[:-1][order] + first_never, never_sizes[order]
        #: Queries with one way to be satisfied, by the number of conditions; all ways of the others.
        self.single: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        alone = ways[code] == 1
        for size in np.unique(sizes[alone]):
            rows = np.flatnonzero(alone & (sizes == size))
            for part in np.array_split(rows, -(-len(rows) * int(size) // WORDS)):
                named = place[starts[part][:, None] + np.arange(size)]
                # What few queries ask for comes first: it is most likely to be absent.
                named = np.take_along_axis(named, np.argsort(asked[named], axis=1, kind="stable"), axis=1)
                self.single.append((code[part], named, part))
        self.several = np.flatnonzero(~alone)
        self.code, self.starts, self.sizes = code[self.several], starts[self.several], sizes[self.several]
        self.counts = np.zeros(len(self.asks), np.int64)
        self.met = np.zeros(0, bool)
        self.open: int | None = None

    def _padded(self, starts: np.ndarray, sizes: np.ndarray, pad: int | None) -> np.ndarray:
        """The atoms of each row; short rows are filled with ``pad`` or their first atom."""
        at = np.arange(int(sizes.max(initial=0)))[None, :]
        index = np.where(at < sizes[:, None], starts[:, None] + at, starts[:, None])
        found = self.place[np.minimum(index, len(self.place) - 1)]
        return found if pad is None else np.where(at < sizes[:, None], found, pad)

    def _held(self, bits: np.ndarray, named: np.ndarray, rows: np.ndarray) -> np.ndarray:
        held = bits[self.slot[named[:, 0]]]
        for column in named.T[1:]:
            held &= bits[self.slot[column]]
        some = np.flatnonzero(self.n_off[rows])
        if len(some):
            less = held[some]
            for column in self._padded(self.off[rows[some]], self.n_off[rows[some]], len(self.atoms)).T:
                less &= ~bits[self.slot[column]]
            held[some] = less
        return held

    def _fit(self, named: np.ndarray) -> np.ndarray:
        fit = np.flatnonzero(self.slot[named[:, 0]])
        for i in range(1, named.shape[1]):
            fit = fit[self.slot[named[fit, i]] > 0]
        return fit

    def _matches(self, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of queries and the entities that satisfy them, as bits; each query once."""
        for code, named, rows in self.single:
            fit = self._fit(named)
            for start in range(0, len(fit), SLICE):
                part = fit[start : start + SLICE]
                yield code[part], self._held(bits, named[part], rows[part])
        last, before = -1, bits[:1]
        for start in range(0, len(self.several), SLICE):
            part = slice(start, start + SLICE)
            named = self._padded(self.starts[part], self.sizes[part], None)
            fit = self._fit(named)
            if not len(fit):
                continue
            code = self.code[part][fit]
            held = self._held(bits, named[fit], self.several[part][fit])
            new = np.flatnonzero(np.diff(code, prepend=-1))
            code, held = code[new], np.bitwise_or.reduceat(held, new, axis=0)
            if code[0] == last:
                held[0] |= before[0]
            elif last >= 0:
                yield np.array([last]), before
            last, before = int(code[-1]), held[-1:].copy()
            yield code[:-1], held[:-1]
        if last >= 0:
            yield np.array([last]), before

    def entities(self, batch: pa.RecordBatch) -> _Entities:
        """The batch's entities with what the chunk asks for."""
        gaps, often = _numbers(batch.column("common"))
        common = self.common[_summed(gaps, often)]
        hashes, seldom = _flat(batch.column("rare"))
        hashes = hashes.view(np.uint64)
        rare = np.minimum(np.searchsorted(self.atoms, hashes), len(self.atoms) - 1)
        rare = np.where(self.atoms[rare] == hashes, rare, -1)
        rows = np.arange(batch.num_rows)
        owner = np.concatenate([np.repeat(rows, often), np.repeat(rows, seldom)])
        atom = np.concatenate([common, rare])
        owner, atom = owner[atom >= 0], atom[atom >= 0]
        sizes = np.bincount(owner, minlength=len(rows))
        return _Entities(batch.column("key").to_numpy(), sizes, atom[np.argsort(owner, kind="stable")])

    def add(self, entities: _Entities) -> _Entities:
        """Counts the entities but those of the last id, of which more may follow; these come back."""
        keys = entities.keys
        if self.open is not None:
            more = int(np.searchsorted(keys, self.open, side="right"))
            self._strip(entities, np.arange(more), self._any)
            if more == len(keys):
                return entities.part(more, more)
            self.open = None
            entities = entities.part(more, len(keys))
            keys = entities.keys
        last = int(np.searchsorted(keys, keys[-1]))
        if len(keys) - last > WIDTH:
            self.finish(entities.part(0, last))
            self.open, self.met = int(keys[-1]), np.zeros(len(self.asks), bool)
            self._strip(entities, np.arange(last, len(keys)), self._any)
            last = len(keys)
        else:
            self.finish(entities.part(0, last))
        return entities.part(last, len(keys))

    def finish(self, entities: _Entities) -> None:
        """Counts entities of which all rows are here: ids with one row by bits, the others by id."""
        keys = entities.keys
        same = keys[1:] == keys[:-1]
        repeated = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(keys) else np.zeros(0, bool)
        self._strip(entities, np.flatnonzero(~repeated), self._each)
        if repeated.any():
            self._repeated(entities, np.flatnonzero(repeated))

    def _repeated(self, entities: _Entities, rows: np.ndarray) -> None:
        firsts = np.flatnonzero(np.diff(entities.keys[rows])) + 1
        if not len(firsts):
            self.met = np.zeros(len(self.asks), bool)
            self._strip(entities, rows, self._any)
            return
        starts = np.concatenate([[0], firsts])

        def count(code: np.ndarray, held: np.ndarray) -> None:
            flags = np.unpackbits(held.view(np.uint8), axis=1, count=len(rows))
            self.counts[code] += np.maximum.reduceat(flags, starts, axis=1).sum(axis=1, dtype=np.int64)

        if len(rows) > WIDTH or not self._pass(entities, rows, count):
            cut = int(firsts[np.argmin(np.abs(firsts - len(rows) // 2))])
            self._repeated(entities, rows[:cut])
            self._repeated(entities, rows[cut:])

    def _each(self, code: np.ndarray, held: np.ndarray) -> None:
        self.counts[code] += np.bitwise_count(held).sum(axis=1, dtype=np.int64)

    def _any(self, code: np.ndarray, held: np.ndarray) -> None:
        """For rows of one id: ``met`` are the queries that have counted it."""
        now = code[held.any(axis=1)]
        self.counts[now] += ~self.met[now]
        self.met[now] = True

    def _strip(self, entities: _Entities, rows: np.ndarray, count: Callable) -> None:
        for low in range(0, len(rows), WIDTH):
            some = rows[low : low + WIDTH]
            if not self._pass(entities, some, count):
                for half in np.array_split(some, 2):
                    self._strip(entities, half, count)

    def _pass(self, entities: _Entities, rows: np.ndarray, count: Callable) -> bool:
        """``count`` for all queries that some of the entities satisfy; False if the bits would be too many."""
        column, atom = entities.taken(rows)
        self.slot[atom] = 1
        here = np.flatnonzero(self.slot)
        width = -(-len(rows) // 64) * 8
        if (len(here) + 1) * width > STRIP_BYTES and len(rows) > 64:
            self.slot[here] = 0
            return False
        self.slot[here] = np.arange(1, len(here) + 1)
        bits = np.zeros((len(here) + 1) * width, np.uint8)
        at = self.slot[atom].astype(np.int64) * width + (column >> 3)
        np.bitwise_or.at(bits, at, (128 >> (column & 7)).astype(np.uint8))
        for code, held in self._matches(bits.view(np.uint64).reshape(len(here) + 1, -1)):
            count(code, held)
        self.slot[here] = 0
        return True

    def found(self) -> pa.RecordBatch:
        some = np.flatnonzero(self.counts)
        return pa.RecordBatch.from_arrays([pa.array(self.asks[some]), pa.array(self.counts[some])], schema=_FOUND)


def cell(known: Known) -> Callable:
    """Rows of one cell, packed queries before entities, these by ``key``, to ``FOUND``.

    Each query's distinct ids that satisfy it; nothing for queries without any. Several ``must``
    and ``never`` of one ``ask`` are ways to satisfy it; ``must`` is never empty.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, chunk, left = [], None, None
        for batch in batches:
            split = batch.column("key").null_count
            if split:
                packed.append(_unpacked(batch.slice(0, split), known))
            batch = batch.slice(split)
            if not batch.num_rows or not (packed or chunk):
                continue
            if chunk is None:
                chunk, packed = _Chunk(packed, known), []
            entities = chunk.entities(batch)
            left = chunk.add(left.with_more(entities) if left is not None else entities)
        if chunk is not None:
            chunk.finish(left)
            yield chunk.found()

    return run
