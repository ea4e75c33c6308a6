"""All terms of a lexicon found in one pass over a text, as substrings.

An automaton over every term is built once a worker; a text is read once,
however many terms there are. Short texts (titles, skills, headlines) recur:
what a worker found in one is kept, up to ``MEMO`` of them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts whose terms a worker remembers, and the characters such a text has at most.
MEMO, MEMO_CHARS = 50_000, 200


@functools.cache
def _automaton(terms: tuple[str, ...]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for i, t in enumerate(terms):
        a.add_word(t, i)
    a.make_automaton()
    return a


@functools.cache
def _memo(terms: tuple[str, ...]) -> dict[str, list[int]]:
    return {}


def find(text: str | None, terms: tuple[str, ...]) -> list[int]:
    """Numbers of the terms that occur in ``text``, ascending."""
    if not text or not terms:
        return []
    memo = _memo(terms)
    if (known := memo.get(text)) is not None:
        return known
    found = sorted({i for _, i in _automaton(terms).iter(text)})
    if len(text) <= MEMO_CHARS:
        if len(memo) >= MEMO:
            memo.clear()
        memo[text] = found
    return found


def term_ids(terms: Sequence[str]) -> Callable[[Column], Column]:
    """A function of an array of texts that gives, for each, the numbers of the terms in it (their places in ``terms``)."""
    terms = tuple(terms)
    if "" in terms:
        raise ValueError("an empty term is in every text")

    @F.arrow_udf("array<array<int>>")
    def ids(texts: pa.Array) -> pa.Array:
        flat = texts.flatten()
        found = [find(t, terms) for t in flat.to_pylist()]
        inner = np.cumsum([0, *map(len, found)], dtype=np.int32)
        each = pa.ListArray.from_arrays(pa.array(inner), pa.array([i for f in found for i in f], pa.int32()))
        sizes = np.asarray(texts.value_lengths().fill_null(0), np.int32)
        return pa.ListArray.from_arrays(pa.array(np.append(np.int32(0), np.cumsum(sizes, dtype=np.int32))), each)

    return ids


def at(terms: Sequence[str], found: Column, wanted: Sequence[str]) -> Column:
    """The terms among ``wanted`` whose numbers are in ``found``, in its order."""
    places = {t: i for i, t in enumerate(terms)}
    own = F.array_intersect(found, F.lit([places[t] for t in wanted]).cast("array<int>"))
    return F.transform(own, lambda i: F.element_at(F.lit(list(terms)), i + 1))


def any_of(terms: Sequence[str], found: Column, wanted: Sequence[str]) -> Column:
    """Whether ``found`` has a number of one of ``wanted``."""
    places = {t: i for i, t in enumerate(terms)}
    return F.arrays_overlap(found, F.lit([places[t] for t in wanted]).cast("array<int>"))
