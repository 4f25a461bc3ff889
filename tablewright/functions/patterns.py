"""Texts of a pattern by number: a pattern is a tree of classes, repeats and branches whose strings are counted and numbered.

Order of the strings: branches as written; shorter repeats before longer ones; of equal lengths the last place moves fastest, and
a class runs as written (``[a-z0-9.]``: letters, digits, point). Anchors stand for nothing. Strings beyond number 2^60 have no number;
``drawn`` reaches them all the same, as it draws the parts of a large pattern one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions.hashing import SEED, hash_hex

LARGEST = 1 << 60
DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
SHORTHAND = {"d": DIGITS, "w": LETTERS.upper() + LETTERS + DIGITS + "_", "s": " ", "t": "\t", "n": "\n"}
PRINTABLE = "".join(map(chr, range(32, 127)))


@dataclass(frozen=True)
class Chars:
    """One character of a class."""

    items: str

    @property
    def count(self) -> int:
        return len(self.items)

    def text(self, number: int) -> str:
        return self.items[number]

    def column(self, number: Column) -> Column:
        if self.count == 1:
            return F.lit(self.items)
        return F.substring(F.lit(self.items), (number + F.lit(1)).cast("int"), F.lit(1))

    def drawn(self, draw) -> Column:
        return self.column(draw(self.count))


@dataclass(frozen=True)
class Chain:
    """Parts one after the other."""

    parts: tuple

    @property
    def count(self) -> int:
        return reduce(lambda n, p: n * p.count, self.parts, 1)

    def text(self, number: int) -> str:
        out = []
        for p in reversed(self.parts):
            number, rest = divmod(number, p.count)
            out.append(p.text(rest))
        return "".join(reversed(out))

    def column(self, number: Column) -> Column:
        out, below = [], 1
        for p in reversed(self.parts):
            if p.count == 1 or below >= LARGEST:
                out.append(p.column(F.lit(0).cast("bigint")))
                continue
            place = _div(number, below)
            out.append(p.column(place % F.lit(p.count) if below * p.count < LARGEST else place))
            below *= p.count
        return F.concat(*reversed(out)) if out else F.lit("")

    def drawn(self, draw) -> Column:
        """Parts that can be numbered together share a draw."""
        out, held = [], []
        for p in (*self.parts, None):
            if held and (p is None or reduce(lambda n, q: n * q.count, (*held, p), 1) > LARGEST):
                whole = Chain(tuple(held))
                out.append(_once(draw(whole.count), whole) if whole.count <= LARGEST else held[0].drawn(draw))
                held = []
            if p is not None:
                held.append(p)
        return F.concat(*out) if out else F.lit("")


@dataclass(frozen=True)
class Branches:
    """One of several."""

    options: tuple

    @property
    def count(self) -> int:
        return sum(o.count for o in self.options)

    def text(self, number: int) -> str:
        for o in self.options:
            if number < o.count:
                return o.text(number)
            number -= o.count
        raise IndexError("the pattern has fewer strings")

    def column(self, number: Column) -> Column:
        first, tests = 0, []
        for o in self.options:
            if first >= LARGEST:
                break
            tests.append((first + o.count, o.column(number - F.lit(first) if first else number)))
            first += o.count
        out = tests[-1][1]
        for end, value in reversed(tests[:-1]):
            out = F.when(number < F.lit(end), value).otherwise(out)
        return out

    def drawn(self, draw) -> Column:
        if self.count <= LARGEST:
            return _once(draw(self.count), self)
        number, values = draw(len(self.options)), [o.drawn(draw) for o in self.options]
        out = values[-1]
        for i, value in reversed(list(enumerate(values[:-1]))):
            out = F.when(number == i, value).otherwise(out)
        return out


@dataclass(frozen=True)
class Word:
    """Between ``low`` and ``high`` characters of one class; as ``Branches`` of chains would do it, in a short expression."""

    items: str
    low: int
    high: int

    @property
    def count(self) -> int:
        return sum(len(self.items) ** n for n in range(self.low, self.high + 1))

    def text(self, number: int) -> str:
        for n in range(self.low, self.high + 1):
            if number < len(self.items) ** n:
                return Chain((Chars(self.items),) * n).text(number)
            number -= len(self.items) ** n
        raise IndexError("the pattern has fewer strings")

    def column(self, number: Column) -> Column:
        base, first, length, before = len(self.items), 0, None, None
        for n in range(self.low, self.high + 1):
            if first >= LARGEST:
                break
            fits = number >= F.lit(first)
            length = F.lit(n) if length is None else F.when(fits, n).otherwise(length)
            before = F.lit(0).cast("bigint") if before is None else F.when(fits, F.lit(first).cast("bigint")).otherwise(before)
            first += base**n
        powers = F.array(*[F.lit(base**i).cast("bigint") for i in range(min(self.high, 60)) if base**i < LARGEST])

        def letter(i: Column) -> Column:
            """The character ``i`` places from the end; so far to the front that no number reaches it, the first one."""
            place = F.call_function("div", number - before, F.coalesce(F.get(powers, i), F.lit(LARGEST).cast("bigint"))) % F.lit(base)
            return F.substring(F.lit(self.items), (place + F.lit(1)).cast("int"), F.lit(1))

        places = F.when(length > 0, F.sequence(length - 1, F.lit(0), F.lit(-1))).otherwise(F.array().cast("array<int>"))
        return F.array_join(F.transform(places, letter), "")

    def drawn(self, draw) -> Column:
        if self.count <= LARGEST:
            return _once(draw(self.count), self)
        chars = Chars(self.items)
        return Branches(tuple(Chain((chars,) * n) for n in range(self.low, self.high + 1))).drawn(draw)


def _once(number: Column, node) -> Column:
    """The string of a number that is worked out once, however often the string's parts refer to it."""
    return F.element_at(F.transform(F.array(number), node.column), 1)


def _div(number: Column, by: int) -> Column:
    """Whole-number quotient; a double could not hold all numbers."""
    return number if by == 1 else F.call_function("div", number, F.lit(by).cast("bigint"))


def _repeat(node, low: int, high: int):
    if isinstance(node, Chars) and node.count > 1 and high > 1:
        return Word(node.items, low, high)
    options = tuple(Chain((node,) * n) for n in range(low, high + 1))
    return options[0] if len(options) == 1 else Branches(options)


class _Reader:
    def __init__(self, pattern: str, most: int):
        self.pattern, self.at, self.most = pattern, 0, most

    def peek(self) -> str:
        return self.pattern[self.at:self.at + 1]

    def take(self) -> str:
        c = self.peek()
        if not c:
            raise ValueError(f"the pattern ends too early: {self.pattern}")
        self.at += 1
        return c

    def branches(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.at += 1
            options.append(self.sequence())
        return options[0] if len(options) == 1 else Branches(tuple(options))

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            node = self.single()
            if node is not None:
                parts.append(self.repeated(node))
        return Chain(tuple(parts))

    def single(self):
        c = self.take()
        if c in "^$":
            return None
        if c == "(":
            if self.peek() == "?":
                if self.pattern[self.at:self.at + 2] != "?:":
                    raise ValueError(f"only plain groups can be made: {self.pattern}")
                self.at += 2
            node = self.branches()
            if self.take() != ")":
                raise ValueError(f"a group is not closed: {self.pattern}")
            return node
        if c == "[":
            return Chars(self.members())
        if c == ".":
            return Chars(PRINTABLE)
        if c == "\\":
            c = self.take()
            if c in "bBAzZ":
                return None
            if c in SHORTHAND:
                return Chars(SHORTHAND[c])
            if c.isalnum():
                raise ValueError(f"no strings for \\{c}: {self.pattern}")
        elif c in "*+?{})":
            raise ValueError(f"nothing to repeat at {c}: {self.pattern}")
        return Chars(c)

    def members(self) -> str:
        negated = self.peek() == "^"
        self.at += negated
        found: dict[str, None] = {}
        while self.peek() != "]" or not found:
            c = self.take()
            if c == "\\":
                c = self.take()
                if c in SHORTHAND:
                    found.update(dict.fromkeys(SHORTHAND[c]))
                    continue
            if self.peek() == "-" and self.pattern[self.at + 1:self.at + 2] not in ("]", ""):
                self.at += 1
                end = self.take()
                end = self.take() if end == "\\" else end
                if end < c:
                    raise ValueError(f"a range runs backwards: {self.pattern}")
                found.update(dict.fromkeys(map(chr, range(ord(c), ord(end) + 1))))
            else:
                found[c] = None
        self.at += 1
        return "".join(c for c in PRINTABLE if c not in found) if negated else "".join(found)

    def repeated(self, node):
        c = self.peek()
        if c == "?":
            low, high = 0, 1
        elif c in ("*", "+"):
            low, high = int(c == "+"), None
        elif c == "{":
            end = self.pattern.index("}", self.at)
            first, comma, last = self.pattern[self.at + 1:end].partition(",")
            low = int(first or 0)
            high = int(last) if last else None if comma else low
            self.at = end
        else:
            return node
        self.at += 1
        if self.peek() in ("?", "+"):  # how greedy a search would be does not matter here
            self.at += 1
        high = low + self.most if high is None else high
        if high < low:
            raise ValueError(f"a repeat runs backwards: {self.pattern}")
        return _repeat(node, low, high)


@lru_cache
def tree(pattern: str, most: int = 8):
    """The strings of a pattern; a repeat without an end goes ``most`` times beyond its least."""
    reader = _Reader(pattern, most)
    node = reader.branches()
    if reader.at < len(pattern):
        raise ValueError(f"a group is closed that is not open: {pattern}")
    if node.count == 0:
        raise ValueError(f"nothing matches {pattern}")
    return node


def size(pattern: str) -> int:
    """How many different numbers a pattern has strings for. Strings that it can make in two ways count twice."""
    return min(tree(pattern).count, LARGEST)


def numbered(pattern: str, number: Column) -> Column:
    """The string of a number from 0 to ``size`` - 1."""
    return _once(number.cast("bigint"), tree(pattern))


def drawn(pattern: str, label: str, source: Column, seed: str = SEED) -> Column:
    """A string of the pattern for ``source``, the same one every time."""
    turn = iter(range(1 << 20))

    def draw(count: int) -> Column:
        n = next(turn)
        return F.conv(F.substring(hash_hex(label, source, n, seed), 1, 15), 16, 10).cast("bigint") % F.lit(count) if count > 1 else F.lit(0).cast("bigint")

    return tree(pattern).drawn(draw)


def strings(pattern: str, first: int = 0, last: int | None = None) -> Sequence[str]:
    """Some of a pattern's strings in order, for looking at."""
    node = tree(pattern)
    return [node.text(n) for n in range(first, min(node.count, LARGEST) if last is None else last)]
