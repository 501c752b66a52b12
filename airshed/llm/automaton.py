"""Many search patterns in one deterministic automaton over bytes.

Patterns are written in a small regular language: characters, escapes, classes, groups, ``|`` and the repeats ``? * +
{m} {m,} {m,n}``. Each becomes a nondeterministic automaton; subset construction over all patterns at once and
minimisation give one transition array, so a text is read once whatever the number of patterns.

For every pattern the scan reports leftmost, non-overlapping, longest matches. Once a search has matched, only the
threads that matched live on; when the last dies, the match has ended and the search begins anew. This needs patterns
that keep matching until they die, such as those that end in a repeated class or a fixed character (checked at
compilation). The start of a match is found by running the reversed pattern back from its end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "f": "\f", "v": "\v"}
ALL_BYTES = frozenset(range(256))


@dataclass
class Nfa:
    """States with byte-set edges and empty edges; one start and one accepting state per pattern."""

    edges: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)
    empty: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in found:
                    found.add(t)
                    todo.append(t)
        return frozenset(found)

    def move(self, states, byte: int) -> frozenset[int]:
        return self.closure({t for s in states for chars, t in self.edges[s] if byte in chars})

    def reversed(self) -> Nfa:
        back = Nfa([[] for _ in self.edges], [[] for _ in self.empty])
        for s, edges in enumerate(self.edges):
            for chars, t in edges:
                back.edges[t].append((chars, s))
        for s, targets in enumerate(self.empty):
            for t in targets:
                back.empty[t].append(s)
        return back


class _Parser:
    """Recursive descent over a pattern; every method returns a tree node."""

    def __init__(self, pattern: str, ignore_case: bool):
        self.p, self.at, self.fold = pattern, 0, ignore_case

    def peek(self) -> str:
        return self.p[self.at:self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.p[self.at - 1]

    def parse(self):
        node = self.union()
        if self.at < len(self.p):
            raise ValueError(f"unexpected {self.peek()!r} at {self.at} of {self.p!r}")
        return node

    def union(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("union", options)

    def sequence(self):
        items = []
        while self.peek() not in ("", "|", ")"):
            items.append(self.repeat(self.atom()))
        return ("seq", items)

    def repeat(self, node):
        bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(self.peek())
        if bounds:
            self.take()
        elif self.peek() == "{":
            end = self.p.index("}", self.at)
            low, comma, high = self.p[self.at + 1:end].partition(",")
            bounds = (int(low), int(high) if high else None if comma else int(low))
            self.at = end + 1
        return ("repeat", node, *bounds) if bounds else node

    def atom(self):
        c = self.take()
        if c == "(":
            node = self.union()
            if self.peek() != ")":
                raise ValueError(f"unclosed group in {self.p!r}")
            self.take()
            return node
        if c == "[":
            return ("chars", self.klass())
        if c in "*+?{})]^$.":
            raise ValueError(f"{c!r} must be escaped in {self.p!r}")
        return ("chars", self.folded({self.escape() if c == "\\" else self.byte(c)}))

    @staticmethod
    def byte(c: str) -> int:
        if ord(c) > 127:
            raise ValueError("patterns are ASCII")
        return ord(c)

    def escape(self) -> int:
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.p[self.at - 2:self.at], 16)
        if c.isalnum() and c not in _ESCAPES:
            raise ValueError(f"unknown escape \\{c}")
        return self.byte(_ESCAPES.get(c, c))

    def klass(self) -> frozenset[int]:
        negated = self.peek() == "^"
        if negated:
            self.take()
        found: set[int] = set()
        while self.peek() != "]":
            c = self.take()
            low = self.escape() if c == "\\" else self.byte(c)
            high = low
            if self.peek() == "-" and self.p[self.at + 1] != "]":
                self.take()
                c = self.take()
                high = self.escape() if c == "\\" else self.byte(c)
            found.update(range(low, high + 1))
        self.take()
        return ALL_BYTES - self.folded(found) if negated else self.folded(found)

    def folded(self, found: set[int]) -> frozenset[int]:
        if self.fold:
            found = found | {ord(chr(b).swapcase()) for b in found if chr(b).isascii() and chr(b).isalpha()}
        return frozenset(found)


def _build(nfa: Nfa, node, start: int) -> int:
    """Add a tree to the automaton behind ``start``; returns its end."""
    if node[0] == "chars":
        end = nfa.state()
        nfa.edges[start].append((node[1], end))
        return end
    if node[0] == "seq":
        for item in node[1]:
            start = _build(nfa, item, start)
        return start
    if node[0] == "union":
        end = nfa.state()
        for option in node[1]:
            begin = nfa.state()
            nfa.empty[start].append(begin)
            nfa.empty[_build(nfa, option, begin)].append(end)
        return end
    _, inner, low, high = node
    for _ in range(low):
        start = _build(nfa, inner, start)
    if high is None:
        loop = nfa.state()
        nfa.empty[start].append(loop)
        nfa.empty[_build(nfa, inner, loop)].append(loop)
        return loop
    end = nfa.state()
    nfa.empty[start].append(end)
    for _ in range(high - low):
        start = _build(nfa, inner, start)
        nfa.empty[start].append(end)
    return end


class CombinedAutomaton:
    """One minimal automaton for all patterns ``(pattern, ignore_case)``; matches carry the pattern's number."""

    def __init__(self, patterns: list[tuple[str, bool]]):
        self.nfa = Nfa()
        self.starts, self.accepts = [], []
        for pattern, fold in patterns:
            start = self.nfa.state()
            self.starts.append(start)
            self.accepts.append(_build(self.nfa, _Parser(pattern, fold).parse(), start))
        for k, (start, accept) in enumerate(zip(self.starts, self.accepts)):
            if accept in self.nfa.closure({start}):
                raise ValueError(f"pattern {patterns[k][0]!r} matches the empty text")
        self.back = self.nfa.reversed()
        self._back_moves: dict[tuple[frozenset[int], int], frozenset[int]] = {}
        self._determinise()

    # --- compilation ---------------------------------------------------------------------------------------------

    def _byte_classes(self) -> tuple[bytes, list[int]]:
        """Bytes that no edge tells apart share a class: the class of each byte, a byte of each class."""
        sets = list({chars for edges in self.nfa.edges for chars, _ in edges})
        classes: dict[tuple[bool, ...], int] = {}
        of = bytes(classes.setdefault(tuple(b in s for s in sets), len(classes)) for b in range(256))
        return of, [of.index(k) for k in range(len(classes))]

    def _advance(self, rule: int, matched: bool, threads: frozenset[int], byte: int) -> tuple[bool, frozenset[int], bool]:
        """The search of one pattern after a byte: (matched, threads, whether a match ended before the byte)."""
        accept, fresh = self.accepts[rule], self.nfa.closure({self.starts[rule]})
        ended = False
        if matched:
            then = self.nfa.move(threads, byte)
            if then:
                if accept not in then:
                    raise ValueError(f"pattern {rule} can leave a match and come back to it")
                return True, then, False
            threads, ended = fresh, True
        hit = [s for s in threads if accept in self.nfa.move({s}, byte)]
        if hit:
            return True, self.nfa.move(hit, byte), ended
        return False, self.nfa.move(threads, byte) | fresh, ended

    def _determinise(self) -> None:
        self.class_of, sample = self._byte_classes()
        moved: dict = {}  # searches of one pattern come up in many combinations
        first = (tuple((False, self.nfa.closure({s})) for s in self.starts), 0)
        number, order, moves = {first: 0}, [first], []
        for searches, _ in order:  # grows while it is read
            row = []
            for byte in sample:
                after, ended = [], 0
                for rule, search in enumerate(searches):
                    step = moved.get((rule, search, byte))
                    if step is None:
                        matched, threads, over = self._advance(rule, *search, byte)
                        step = moved[rule, search, byte] = ((matched, threads), over << rule)
                    after.append(step[0])
                    ended |= step[1]
                state = (tuple(after), ended)
                if state not in number:
                    number[state] = len(order)
                    order.append(state)
                row.append(number[state])
            moves.append(row)
        ended = [e for _, e in order]
        open_ = [sum(m << k for k, (m, _) in enumerate(searches)) for searches, _ in order]
        self.n_subsets = len(order)
        self._minimise(moves, ended, open_)

    def _minimise(self, moves: list[list[int]], ended: list[int], open_: list[int]) -> None:
        """Merge states that no text tells apart: refine blocks by their successors' blocks until nothing splits."""
        names: dict = {}
        block = [names.setdefault((e, o), len(names)) for e, o in zip(ended, open_)]
        while True:
            names = {}
            finer = [names.setdefault((b, tuple(block[t] for t in row)), len(names)) for b, row in zip(block, moves)]
            if len(names) == len(set(block)):
                break
            block = finer
        head: dict[int, int] = {}
        for s, b in enumerate(block):
            head.setdefault(b, s)
        quiet = sorted((b for b in head if not ended[head[b]]), key=lambda b: b != block[0])
        order = quiet + [b for b in head if ended[head[b]]]
        place = {b: k for k, b in enumerate(order)}
        width = len(moves[0])
        self.n_states, self.width = len(order), width
        self.table = [place[block[t]] * width for b in order for t in moves[head[b]]]
        self.first_event = len(quiet) * width
        rules = range(len(self.starts))
        self.ended = {k * width: [r for r in rules if ended[head[b]] >> r & 1] for k, b in enumerate(order)}
        self.open = {k * width: [r for r in rules if open_[head[b]] >> r & 1] for k, b in enumerate(order)}

    # --- scanning ------------------------------------------------------------------------------------------------

    def ends(self, data: bytes) -> Iterator[tuple[int, int]]:
        """``(pattern, end)`` of every match, in one pass over the bytes."""
        table, first_event, ended = self.table, self.first_event, self.ended
        state = 0
        for at, c in enumerate(data.translate(self.class_of)):
            state = table[state + c]
            if state >= first_event:
                for rule in ended[state]:
                    yield rule, at
        for rule in self.open[state]:
            yield rule, len(data)

    def _start(self, rule: int, data: bytes, end: int, after: int) -> int:
        """The leftmost start, not before ``after``, of a match that ends at ``end``."""
        goal, threads, found = self.starts[rule], self.back.closure({self.accepts[rule]}), end
        for at in range(end - 1, after - 1, -1):
            key = (threads, data[at])
            then = self._back_moves.get(key)
            if then is None:
                then = self._back_moves[key] = self.back.move(*key)
            if not then:
                break
            threads = then
            if goal in threads:
                found = at
        return found

    def matches(self, data: bytes) -> list[tuple[int, int, int]]:
        """``(start, pattern, end)`` of every match, sorted."""
        after = [0] * len(self.starts)
        out = []
        for rule, end in self.ends(data):
            out.append((self._start(rule, data, end, after[rule]), rule, end))
            after[rule] = end
        return sorted(out)
