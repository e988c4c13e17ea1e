"""Tables of patterns over texts in one pass.

Most patterns cannot match without one of a few words, and no match of theirs runs across
certain marks.  Both follow from the pattern's own syntax: ``needles`` are literals of which
every match holds one, ``walls`` the marks that no match holds.  An automaton finds the
needles of all tables in one pass over a text; a pattern then looks only at the stretches
between walls that hold one of its needles.  A pattern without needles looks at the
whole text, and so does one without walls once a needle is met.  The matches are those of
the pattern over the whole text.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from re import _parser as parser  # the syntax tree that the standard library compiles

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Marks that may bound a match.
MARKS = ".;:!?()[]{}<>/|\"'"
#: Needles shorter than this are no help.
SHORTEST = 4
_PAUSE = re.compile(r"(?<=[.!?])\s+")
_KINDS = {"CATEGORY_DIGIT": r"\d", "CATEGORY_NOT_DIGIT": r"\D", "CATEGORY_SPACE": r"\s", "CATEGORY_NOT_SPACE": r"\S", "CATEGORY_WORD": r"\w", "CATEGORY_NOT_WORD": r"\W"}
_REPEATS = ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT")


def folded(text: str) -> str:
    """Lower case, of the same length: places in it are places in the text."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text).replace("İ", "i")
    return low if low.isascii() else low.replace("ſ", "s").replace("ı", "i")


def _named(tree) -> list[tuple[str, object]]:
    return [(str(kind), value) for kind, value in tree]


def needles(tree) -> frozenset[str]:
    """Literals in lower case of which every match holds one; none if that cannot be told."""
    best: frozenset[str] = frozenset()
    run = ""

    def consider(found: frozenset[str]):
        nonlocal best
        if found and (not best or min(map(len, found)) > min(map(len, best))):
            best = found

    for kind, value in _named(tree):
        if kind == "LITERAL":
            run += folded(chr(value))
            continue
        consider(frozenset([run]) if run else frozenset())
        run = ""
        if kind == "SUBPATTERN":
            consider(needles(value[3]))
        elif kind == "BRANCH":
            each = [needles(x) for x in value[1]]
            consider(frozenset().union(*each) if all(each) else frozenset())
        elif kind in _REPEATS and value[0] > 0:
            consider(needles(value[2]))
        elif kind == "ATOMIC_GROUP":
            consider(needles(value))
    consider(frozenset([run]) if run else frozenset())
    return best


def holds(tree, mark: str) -> bool:
    """Whether a match may hold ``mark``; what is not understood may."""
    code = ord(mark)
    for kind, value in _named(tree):
        if kind == "LITERAL":
            found = value == code
        elif kind == "NOT_LITERAL":
            found = value != code
        elif kind == "IN":
            found = _in(value, mark)
        elif kind == "SUBPATTERN":
            found = holds(value[3], mark)
        elif kind == "BRANCH":
            found = any(holds(x, mark) for x in value[1])
        elif kind in _REPEATS:
            found = holds(value[2], mark)
        else:
            found = kind != "AT"
        if found:
            return True
    return False


def _in(members, mark: str) -> bool:
    code, found, negated = ord(mark), False, False
    for kind, value in _named(members):
        if kind == "NEGATE":
            negated = True
        elif kind == "LITERAL":
            found |= value == code
        elif kind == "RANGE":
            found |= value[0] <= code <= value[1]
        elif kind == "CATEGORY":
            found |= bool(re.match(_KINDS[str(value)], mark))
        else:
            return True
    return found != negated


class Scanner:
    """Patterns, ignoring case, by number; ``look`` finds the needles of all of them in a text."""

    def __init__(self, patterns: list[str]):
        self.patterns = [re.compile(p, re.IGNORECASE) for p in patterns]
        trees = [parser.parse(p, re.IGNORECASE) for p in patterns]
        self.anywhere: set[int] = set()
        self.walls: list[str] = []
        owners: dict[str, set[int]] = {}
        for i, tree in enumerate(trees):
            found = needles(tree)
            if not found or min(map(len, found)) < SHORTEST:
                self.anywhere.add(i)
            for needle in found if i not in self.anywhere else ():
                owners.setdefault(needle, set()).add(i)
            self.walls.append("".join(m for m in MARKS if not holds(tree, m)))
        self.needles = ahocorasick.Automaton()
        for needle, own in owners.items():
            self.needles.add_word(needle, (len(needle), tuple(own)))
        if owners:
            self.needles.make_automaton()
        self.some = bool(owners)

    def look(self, text: str) -> Text:
        places: dict[int, list[int]] = {}
        for end, (length, own) in self.needles.iter(folded(text)) if self.some else ():
            for i in own:
                places.setdefault(i, []).append(end - length + 1)
        return Text(self, text, places)


class Text:
    """One text and where its needles lie."""

    def __init__(self, scanner: Scanner, text: str, places: dict[int, list[int]]):
        self.scanner, self.text, self.places = scanner, text, places
        self.known: dict[int, list[tuple[int, int]]] = {}

    def _stretches(self, i: int) -> Iterator[tuple[int, int]]:
        walls, n = self.scanner.walls[i], len(self.text)
        if i in self.scanner.anywhere or i in self.places and not walls:
            yield 0, n
            return
        upto = 0
        for at in self.places.get(i, ()):
            if at >= upto:
                start = 1 + max(self.text.rfind(mark, upto, at) for mark in walls)
                upto = min((end for mark in walls if (end := self.text.find(mark, at)) >= 0), default=n)
                yield max(start, 0), upto

    def spans(self, i: int) -> list[tuple[int, int]]:
        """Places of all matches of pattern ``i``."""
        if i not in self.known:
            found = self.scanner.patterns[i].finditer
            self.known[i] = [m.span() for start, end in self._stretches(i) for m in found(self.text, start, end)]
        return self.known[i]

    def matches(self, i: int) -> bool:
        """Whether pattern ``i`` matches at all."""
        if i in self.known:
            return bool(self.known[i])
        found = self.scanner.patterns[i].search
        return any(found(self.text, start, end) for start, end in self._stretches(i))

    def first_free(self, wanted: list[tuple[str, int]], masks: list[int]) -> str | None:
        """The first of ``wanted`` (name, pattern) with a match that begins in no match of ``masks``."""
        covered: list[tuple[int, int]] | None = None
        for name, i in wanted:
            spans = self.spans(i)
            if spans and covered is None:
                covered = _merged([s for m in masks for s in self.spans(m)])
            for start, _ in spans:
                k = bisect.bisect_right(covered, (start, len(self.text) + 1)) - 1
                if k < 0 or covered[k][1] <= start:
                    return name
        return None

    def together(self, a: int, b: int) -> bool:
        """Whether one sentence, up to an end mark that white space follows, matches both patterns."""
        if not (self.matches(a) and self.matches(b)):
            return False
        ends = [m.span() for m in _PAUSE.finditer(self.text)]
        starts, stops = [0, *(e for _, e in ends)], [*(s for s, _ in ends), len(self.text)]
        # a match that runs over a pause is none within a sentence
        sentences = [{k for s, e in self.spans(x) if e <= stops[k := bisect.bisect_right(starts, s) - 1]} for x in (a, b)]
        return bool(sentences[0] & sentences[1])


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def names_of(text: Column, tables: dict[str, list[tuple[str, str]]], together: dict[str, tuple[str, str]] | None = None) -> Column:
    """A struct with, for each table, the names of its patterns that the text matches, in their order.

    ``together`` names pairs of patterns that must match in one sentence; each gives a boolean.
    A null text matches nothing.
    """
    together = together or {}
    patterns = [p for table in tables.values() for _, p in table] + [p for pair in together.values() for p in pair]

    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(patterns)
        for texts in batches:
            columns: list[list] = [[] for _ in [*tables, *together]]
            for one in texts:  # of a batch only one text at a time is a string of Python's
                seen, i = scanner.look(one.as_py() or ""), 0
                for column, table in zip(columns, tables.values()):
                    column.append([name for k, (name, _) in enumerate(table, i) if seen.matches(k)])
                    i += len(table)
                for column in columns[len(tables) :]:
                    column.append(seen.together(i, i + 1))
                    i += 2
            types = [pa.list_(pa.string())] * len(tables) + [pa.bool_()] * len(together)
            yield pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[*tables, *together])

    kinds = [f"{name} array<string>" for name in tables] + [f"{name} boolean" for name in together]
    return F.arrow_udf(look, ", ".join(kinds)).asNondeterministic()(text)  # so the plan runs it once a row
