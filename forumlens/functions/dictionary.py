"""Ordered literal replacements out of large dictionaries, in one pass over the text.

The rule is a fold: every pair in turn replaces all its occurrences in what the pairs before left. An
automaton over all keys, built once per worker, tells which keys occur at all; only those are replaced, in
their order. A replacement can complete a later key, which must overlap what was put in, so only
those stretches are read again. The work depends on the text and its matches, not on the number of pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class OrderedPairs:
    """The pairs and the automaton of their keys; of pairs with one key only the first can ever apply to it."""

    def __init__(self, pairs: Sequence[tuple[str, str]], pad: bool) -> None:
        self.pairs = [(k, f" {v} " if pad else v) for k, v in pairs]
        self.reach = max((len(k) for k, _ in self.pairs), default=0)
        self.at: dict[str, list[int]] = {}
        for i, (k, _) in enumerate(self.pairs):
            # An empty key replaces nothing.
            if k:
                self.at.setdefault(k, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for k, places in self.at.items():
            self.automaton.add_word(k, places)
        if self.at:
            self.automaton.make_automaton()

    def met(self, text: str) -> set[int]:
        """Pairs whose key occurs in the text."""
        return {i for _, places in self.automaton.iter(text) for i in places}

    def apply(self, text: str) -> str:
        if not self.at or not text:
            return text
        todo = sorted(self.met(text))
        known = set(todo)
        while todo:
            i = heapq.heappop(todo)
            key, value = self.pairs[i]
            parts = text.split(key)
            if len(parts) == 1:
                continue
            text = value.join(parts)
            # What was put in, with as much text around it as a key could reach.
            stretches, begin, end, at = [], None, None, 0
            for part in parts[:-1]:
                at += len(part)
                low, high = max(0, at - self.reach + 1), at + len(value) + self.reach - 1
                if begin is None or low > end:
                    if begin is not None:
                        stretches.append(text[begin:end])
                    begin = low
                end = high
                at += len(value)
            stretches.append(text[begin:end])
            for stretch in stretches:
                for j in self.met(stretch):
                    if j > i and j not in known:
                        known.add(j)
                        heapq.heappush(todo, j)
        return text


def replace_large(text: Column, pairs: Sequence[tuple[str, str]], pad: bool = True) -> Column:
    """Equal to :func:`forumlens.functions.text.replace_in_order`, for dictionaries of hundreds of pairs and more.

    Null stays null. The pairs travel with the task and are compiled once per batch stream.
    """
    held = list(pairs)

    @F.pandas_udf("string")
    def replaced(batches: pd.Series) -> pd.Series:
        compiled = _compiled(held, pad)
        return pd.Series([None if t is None else compiled.apply(t) for t in batches], dtype=object)

    return replaced(text) if held else text


_LAST: dict[str, tuple[list, bool, OrderedPairs]] = {}


def _compiled(pairs: list[tuple[str, str]], pad: bool) -> OrderedPairs:
    """The automaton of the dictionary used last in this worker."""
    kept = _LAST.get("pairs")
    if kept is None or kept[1] != pad or (kept[0] is not pairs and kept[0] != pairs):
        kept = _LAST["pairs"] = (pairs, pad, OrderedPairs(pairs, pad))
    return kept[2]
