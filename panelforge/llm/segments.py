"""Encoding by segments that no token can cross, with a bounded cache of segments for each worker."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa

#: Entries of one generation of a worker's cache (two are held); longer segments than CACHED_CHARS are not kept.
CACHE_ENTRIES = 300_000
CACHED_CHARS = 48


class Generations:
    """A bounded map from segments to their packed ids.

    When a generation is full it becomes the old one, from which segments that are met again move on, so frequent
    segments stay while memory is bounded. Segments of more than CACHED_CHARS are never kept.
    """

    def __init__(self, entries: int = CACHE_ENTRIES):
        self.entries, self.known, self.old = entries, {}, {}

    def look_up(self, names: list[str]) -> tuple[list[bytes | None], list[int]]:
        """What is known of each name, and the places of those that are new."""
        if len(self.known) > self.entries:
            self.known, self.old = {}, self.known
        known, old, new = self.known, self.old, []
        found = list(map(known.get, names))
        for i in [i for i, x in enumerate(found) if x is None]:
            x = old.get(names[i])
            if x is None:
                new.append(i)
            else:
                known[names[i]] = found[i] = x
        return found, new

    def add(self, names: list[str], ids: list[bytes]) -> None:
        self.known.update((x, y) for x, y in zip(names, ids) if len(x) <= CACHED_CHARS)


class SegmentCache:
    """Ids of segments as packed int32, computed for the new segments of a batch at once.

    When a generation is full it becomes the old one, from which segments that are met again move on, so frequent
    segments stay while memory is bounded.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], entries: int = CACHE_ENTRIES):
        self.encode, self.entries, self.known, self.old = encode, entries, {}, {}

    def ids(self, split_texts: list[list[str]]) -> list[bytes]:
        """The ids of each text (given as its segments), as packed int32."""
        wanted: set[str] = set()
        for parts in split_texts:
            wanted.update(parts)
        known, large = self._learn(wanted)
        if not large:
            get = known.__getitem__
            return [b"".join(map(get, parts)) for parts in split_texts]
        return [b"".join([large[x] if x in large else known[x] for x in parts]) for parts in split_texts]

    def _learn(self, wanted: Iterable[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """The known segments, all of the distinct ``wanted`` among them but for long ones, which come apart."""
        if len(self.known) > self.entries:
            self.known, self.old = {}, self.known
        known, old, new = self.known, self.old, []
        for x in [x for x in wanted if x not in known]:
            if x in old:
                known[x] = old[x]
            else:
                new.append(x)
        now = dict(zip(new, self.encode(new)))
        large = {x: now.pop(x) for x in new if len(x) > CACHED_CHARS}
        known.update(now)
        return known, large


def id_lists(packed: list[bytes]) -> pa.ListArray:
    """An Arrow list<int32> column from packed ids."""
    ends = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in packed], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4")))
