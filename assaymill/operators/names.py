"""Many names looked up in texts in one pass: an automaton over all of them reads every text once, however many names there are."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of all names together that may travel to every task; callers test longer lists text by text.
MAX_CHARS = 16 << 20
#: Names of up to this many characters must stand as words; longer ones may stand anywhere.
WORD_LENGTH = 3


def bounded_names(names: DataFrame, most: int = MAX_CHARS) -> list[str] | None:
    """The distinct non-empty names of a one-column frame, or None if they are too many to broadcast."""
    distinct = names.select(F.col(names.columns[0]).alias("name")).where("name <> ''").distinct()
    return None if (distinct.agg(F.sum(F.length("name"))).first()[0] or 0) > most else [r["name"] for r in distinct.collect()]


class Finder:
    """The automaton of a list of names; lives in a task."""

    def __init__(self, names: list[str]):
        import ahocorasick
        import regex

        self.word = regex.compile(r"[\p{Alphabetic}\p{M}\p{Nd}\p{Pc}‌‍]").match
        self.known: dict[str, bool] = {}
        by_pattern: dict[str, list[str]] = {}
        for name in names:
            by_pattern.setdefault(name.lower() if len(name) <= WORD_LENGTH else name, []).append(name)
        self.automaton = ahocorasick.Automaton()
        for pattern, own in by_pattern.items():
            anywhere = [n for n in own if len(n) > WORD_LENGTH]
            self.automaton.add_word(pattern, (len(pattern), anywhere, [n for n in own if len(n) <= WORD_LENGTH]))
        if by_pattern:
            self.automaton.make_automaton()
        self.some = bool(by_pattern)

    def _is_word(self, text: str, at: int) -> bool:
        if not 0 <= at < len(text):
            return False
        c = text[at]
        if c not in self.known:
            self.known[c] = self.word(c) is not None
        return self.known[c]

    def found(self, low: str | None) -> list[str]:
        """The names in a lower-cased text, sorted."""
        held: set[str] = set()
        for last, (size, anywhere, words) in self.automaton.iter(low) if low and self.some else ():
            held.update(anywhere)
            if words and words[0] not in held:
                first = last - size + 1
                if self._is_word(low, first - 1) != self._is_word(low, first) and self._is_word(low, last) != self._is_word(low, last + 1):
                    held.update(words)
        return sorted(held)


def with_names(texts: DataFrame, text: str, names: list[str], column: str = "names") -> DataFrame:
    """`texts` with the names that stand in their lower-cased column `text`; a null text has none."""
    held = texts.sparkSession.sparkContext.broadcast(names)
    schema = T.StructType([*texts.schema.fields, T.StructField(column, T.ArrayType(T.StringType()))])

    def run(batches):
        finder = Finder(held.value)
        for batch in batches:
            found = [finder.found(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.string()))], schema.names)

    return texts.mapInArrow(run, schema)
