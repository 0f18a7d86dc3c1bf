"""Generalised LR repair of role sequences.

The table is an SLR one, built from the rules below. The parser keeps all
stack tops at once in a graph-structured stack: a node is a table state on a
node below it, and equal nodes are one. Every input symbol may be deleted,
kept or changed to another role, and symbols may be inserted before it, each
at a cost; tops that become equal are merged by the minimum of (cost, audit),
the audit being the initials of the edits so far.

What the tops can do next depends only on the tops, the differences of their
costs, and how their audits compare. These configurations are few, so each
step from one by a row class is made once and remembered; a row costs a look
up, whatever the length of the conversation.
"""

from __future__ import annotations

from array import array
from os.path import commonprefix

#: ``(s?(ua)+)?`` over role initials; capitals are the rules' own names.
RULES = [("S", ""), ("S", "P"), ("S", "sP"), ("P", "ua"), ("P", "Pua")]
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
#: Roles that may be inserted or changed to.
FREE = "ua"
#: Row classes: a role's initial (``x``: none of the grammar), as a capital
#: where the text is truncated, or ``MUST_DELETE``.
MUST_DELETE = "-"
#: Whatever one top can still reach, another can reach for at most this more:
#: two inserts complete a pair, and one delete stands for a system row that
#: only an empty stack can keep. A top dearer than another by more is left.
SLACK = 2 * COST[INSERT] + COST[DELETE]
END = "$"


class Table:
    """SLR table: ``act(state, symbol)`` is ``("shift", state)``,
    ``("reduce", name, length)``, ``("accept",)`` or ``None``."""

    def __init__(self, rules: list[tuple[str, str]] = RULES) -> None:
        self.rules = [("'", rules[0][0]), *rules]
        self.names = {name for name, _ in self.rules}
        self.states = [self._closure(frozenset({(0, 0)}))]
        self.goto: dict[tuple[int, str], int] = {}
        for k, items in enumerate(self.states):  # grows while read
            for symbol in sorted({self.rules[r][1][d] for r, d in items if d < len(self.rules[r][1])}):
                to = self._closure(frozenset((r, d + 1) for r, d in items if self.rules[r][1][d : d + 1] == symbol))
                if to not in self.states:
                    self.states.append(to)
                self.goto[k, symbol] = self.states.index(to)
        self.follow = self._follow()
        self.actions: dict[tuple[int, str], tuple] = {}
        for k, items in enumerate(self.states):
            for r, d in items:
                name, right = self.rules[r]
                if d < len(right):
                    if right[d] not in self.names:
                        self.actions[k, right[d]] = ("shift", self.goto[k, right[d]])
                elif r == 0:
                    self.actions[k, END] = ("accept",)
                else:
                    for symbol in self.follow[name]:
                        if self.actions.setdefault((k, symbol), ("reduce", name, len(right))) != ("reduce", name, len(right)):
                            raise ValueError(f"rules conflict on {symbol!r}")
        #: States that can only reduce, by one rule.
        self.only = {
            k: (self.rules[r][0], len(self.rules[r][1]))
            for k, items in enumerate(self.states)
            if len(items) == 1
            for r, d in items
            if r and d == len(self.rules[r][1])
        }

    def _closure(self, items: frozenset) -> frozenset:
        out, todo = set(items), list(items)
        while todo:
            r, d = todo.pop()
            for k, (name, _) in enumerate(self.rules):
                if self.rules[r][1][d : d + 1] == name and (k, 0) not in out:
                    out.add((k, 0))
                    todo.append((k, 0))
        return frozenset(out)

    def _follow(self) -> dict[str, set[str]]:
        empty: set[str] = set()
        first: dict[str, set[str]] = {n: set() for n in self.names}
        follow: dict[str, set[str]] = {n: set() for n in self.names}
        follow["'"].add(END)
        while True:
            size = (len(empty), sum(map(len, first.values())), sum(map(len, follow.values())))
            for name, right in self.rules:
                if all(c in empty for c in right):
                    empty.add(name)
                for c in right:
                    first[name] |= first.get(c, {c})
                    if c not in empty:
                        break
                after = set(follow[name])
                for c in reversed(right):
                    if c in self.names:
                        follow[c] |= after
                        after = first[c] | (after if c in empty else set())
                    else:
                        after = {c}
            if size == (len(empty), sum(map(len, first.values())), sum(map(len, follow.values()))):
                return follow


def _codes(texts: set[str]) -> dict[str, str]:
    """Short stand-ins that compare, whatever is appended to both sides, as
    the texts do: only the symbols at which texts part are kept."""
    if len(texts) == 1:
        return {t: "" for t in texts}
    common = len(commonprefix(list(texts)))
    if any(len(t) == common for t in texts):
        return {t: t[common:] for t in texts}
    out = {}
    for symbol in {t[common] for t in texts}:
        group = {t for t in texts if t[common] == symbol}
        for rest, code in _codes({t[common + 1 :] for t in group}).items():
            out[next(t for t in group if t[common + 1 :] == rest)] = symbol + code
    return out


class RoleParser:
    """``start`` a conversation's parse, ``step`` through its row classes,
    ``finish`` it."""

    def __init__(self, rules: list[tuple[str, str]] = RULES) -> None:
        self.table = Table(rules)
        self.nodes: list[tuple[int, int]] = [(0, -1)]  # (state, node below)
        self._node = {(0, -1): 0}
        self._configs: dict[tuple, int] = {}
        self._of: list[tuple] = []
        self._steps: dict[tuple[int, str], int] = {}
        #: (next configuration, cost all tops share, (origin, edits) of each top)
        self._made: list[tuple[int, int, tuple[tuple[int, str], ...]]] = []
        self._ends: dict[int, tuple[int, int, str]] = {}
        self._advanced: dict[tuple[int, str], int] = {}
        self.root = self._config(((0, 0, ""),))

    def _on(self, below: int, state: int) -> int:
        if (state, below) not in self._node:
            self._node[state, below] = len(self.nodes)
            self.nodes.append((state, below))
        return self._node[state, below]

    def _reduced(self, node: int, name: str, length: int) -> int:
        for _ in range(length):
            node = self.nodes[node][1]
        return self._on(node, self.table.goto[self.nodes[node][0], name])

    def advance(self, node: int, symbol: str) -> int:
        """The top after ``symbol``, or -1 where the grammar does not take it."""
        key = (node, symbol)
        if key not in self._advanced:
            act = self.table.actions.get((self.nodes[node][0], symbol))
            while act and act[0] == "reduce":
                node = self._reduced(node, *act[1:])
                act = self.table.actions.get((self.nodes[node][0], symbol))
            out = -1
            if act and act[0] == "shift":
                out = self._on(node, act[1])
                while self.nodes[out][0] in self.table.only:
                    out = self._reduced(out, *self.table.only[self.nodes[out][0]])
            self._advanced[key] = out
        return self._advanced[key]

    def accepts(self, node: int) -> bool:
        act = self.table.actions.get((self.nodes[node][0], END))
        while act and act[0] == "reduce":
            node = self._reduced(node, *act[1:])
            act = self.table.actions.get((self.nodes[node][0], END))
        return bool(act)

    def free_role(self, node: int) -> str:
        """The one role that an insert or a change can give here."""
        return next(s for s in FREE if self.advance(node, s) >= 0)

    def _config(self, entries: tuple) -> int:
        if entries not in self._configs:
            self._configs[entries] = len(self._of)
            self._of.append(entries)
        return self._configs[entries]

    def _inserted(self, config: int) -> dict[int, tuple[int, str, int, str]]:
        """All tops after any inserts: ``(cost, audit, origin, edits)``."""
        tops = {node: (cost, code, k, "") for k, (node, cost, code) in enumerate(self._of[config])}
        todo = list(tops)
        while todo:
            cost, audit, origin, edits = tops[node := todo.pop()]
            for symbol in FREE:
                to = self.advance(node, symbol)
                new = (cost + COST[INSERT], audit + INSERT, origin, edits + INSERT)
                if to >= 0 and (to not in tops or new < tops[to]):
                    tops[to] = new
                    todo.append(to)
        return tops

    def _make(self, config: int, row: str) -> int:
        merged: dict[int, tuple[int, str, int, str]] = {}

        def offer(node: int, top: tuple[int, str, int, str], edit: str, cost: int) -> None:
            new = (top[0] + cost, top[1] + edit, top[2], top[3] + edit)
            if node >= 0 and (node not in merged or new < merged[node]):
                merged[node] = new

        for node, top in self._inserted(config).items():
            offer(node, top, DELETE, COST[DELETE])
            if row != MUST_DELETE:
                extra = TRUNCATED_COST if row.isupper() else 0
                offer(self.advance(node, row.lower()), top, KEEP, COST[KEEP] + extra)
                for symbol in FREE:
                    offer(self.advance(node, symbol), top, REROLE, COST[REROLE] + extra)
        base = min(cost for cost, *_ in merged.values())
        live = sorted((node, top) for node, top in merged.items() if top[0] - base <= SLACK)
        codes = _codes({top[1] for _, top in live})
        to = self._config(tuple((node, top[0] - base, codes[top[1]]) for node, top in live))
        self._made.append((to, base, tuple((top[2], top[3]) for _, top in live)))
        return len(self._made) - 1

    def start(self) -> "Parse":
        return Parse(self)

    def step(self, config: int, row: str) -> int:
        key = (config, row)
        if key not in self._steps:
            self._steps[key] = self._make(config, row)
        return self._steps[key]

    def end(self, config: int) -> tuple[int, int, str]:
        """(cost, origin, edits) of the best top the grammar accepts."""
        if config not in self._ends:
            tops = self._inserted(config)
            cost, _, origin, edits = min(top for node, top in tops.items() if self.accepts(node))
            self._ends[config] = (cost, origin, edits)
        return self._ends[config]


class Parse:
    """One conversation: four bytes a row until its audit is read."""

    def __init__(self, parser: RoleParser) -> None:
        self.parser, self.config, self.cost = parser, parser.root, 0
        self.made = array("i")

    def step(self, row: str) -> None:
        k = self.parser.step(self.config, row)
        self.made.append(k)
        self.config, base, _ = self.parser._made[k]
        self.cost += base

    def finish(self) -> tuple[int, str]:
        """The least cost, and the ASCII-least audit that has it."""
        cost, origin, edits = self.parser.end(self.config)
        pieces = [edits]
        for k in reversed(self.made):
            origin, edits = self.parser._made[k][2][origin]
            pieces.append(edits)
        return self.cost + cost, "".join(reversed(pieces))
