"""Which of many stems a text contains, by one pass over the text."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _automaton(stems):
    import ahocorasick
    machine = ahocorasick.Automaton()
    for i, stem in enumerate(stems):
        machine.add_word(stem, i)
    machine.make_automaton()
    return machine


def stems_in(text: Column, stems: list[str]) -> Column:
    """Numbers (places in ``stems``) of the stems that a text contains, ascending; none for a null text.

    All stems are looked for together, so the time grows with the text and its hits, not with the
    number of stems. ``stems`` travel with the function: they must be few enough for a broadcast,
    not empty and different.
    """
    @F.pandas_udf("array<int>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = _automaton(stems)
        for batch in batches:
            yield pd.Series([sorted({i for _, i in machine.iter(t)}) if t else [] for t in batch], dtype=object)
    return found(text)


def count_stems(text: Column, stems: dict[str, set], names) -> Column:
    """A struct with a count for each of ``names``: contained stems that have this name in their set."""
    names = list(names)
    schema = ", ".join(f"{n} int" for n in names)

    @F.pandas_udf(schema)
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine, groups = _automaton(stems), [[n in s for n in names] for s in stems.values()]
        for batch in batches:
            rows = [[sum(column) for column in zip(*(groups[i] for i in hits))] if hits else [0] * len(names)
                    for hits in ({i for _, i in machine.iter(t)} if t else () for t in batch)]
            yield pd.DataFrame(rows, columns=names, dtype="int32")
    return counted(text)
