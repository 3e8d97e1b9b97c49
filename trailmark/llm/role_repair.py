"""Generalised LR repair of a sequence of roles: the cheapest edits that make it legal.

The grammar of ``(s?(ua)+)?`` is parsed from the last row to the first, with an SLR table.
Several stacks live at once; a stack is a node that names its top state and the node below
it, so stacks share what they have in common, and two that reach the same node are one:
the smaller (cost, audit) stays. Edits are parse steps of their own: keep shifts a row's
role, rerole another one, insert shifts a role without a row, delete shifts nothing.

Reading backwards makes the merge exact. Audits grow at their front, so of two stacks with
the same node whatever is put in front is the same for both, and the smaller audit stays
smaller. Audits are not held while parsing: what a row adds (inserts, then one letter for
the row) is a prefix-free code, so (added letters, rank of the audit behind) orders them.

How the live stacks change with a row depends only on their relative costs and ranks, of
which there are few: each change is worked out once and looked up afterwards. A sequence
of n rows costs n lookups and holds n references.
"""

from __future__ import annotations

from functools import lru_cache
from heapq import heapify, heappop, heappush

END = "$"
START = "conv"

# The mirrored role grammar: pairs of assistant and user, then perhaps a system row.
RULES = (
    (START, ()),
    (START, ("pairs",)),
    (START, ("pairs", "s")),
    ("pairs", ("pair",)),
    ("pairs", ("pairs", "pair")),
    ("pair", ("a", "u")),
)

# Costs of the edits, and what an unfinished row costs that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
WRITABLE = ("u", "a")  # roles that rerole and insert may give

# A row as one character: its role's initial (x: another), in capitals if its text is
# truncated, or this one where it has to be deleted.
DOOMED = "d"

MOST_STACKS = 1000


class Table:
    """SLR states, moves and reductions of a grammar."""

    def __init__(self, rules=RULES, start=START) -> None:
        self.rules, self.start = rules, start
        heads = {head for head, _ in rules}
        self.terminals = {s for _, body in rules for s in body} - heads
        self.follow = self._follow(heads)
        self.moves: dict[tuple[int, str], int] = {}
        states = [self._closed({(i, 0) for i, (head, _) in enumerate(rules) if head == start})]
        self.ends = []  # per state: the rules that end there
        for state in states:
            self.ends.append([i for i, dot in state if dot == len(rules[i][1])])
            for symbol in sorted({rules[i][1][dot] for i, dot in state if dot < len(rules[i][1])}):
                after = self._closed(
                    {(i, d + 1) for i, d in state if d < len(rules[i][1]) and rules[i][1][d] == symbol}
                )
                if after not in states:
                    states.append(after)
                self.moves[len(self.ends) - 1, symbol] = states.index(after)

    def _closed(self, items: set) -> frozenset:
        todo = list(items)
        for i, dot in todo:
            body = self.rules[i][1]
            fresh = {
                (j, 0) for j, (head, _) in enumerate(self.rules) if dot < len(body) and head == body[dot]
            }
            todo.extend(fresh - items)
            items = items | fresh
        return frozenset(items)

    def _follow(self, heads: set) -> dict[str, set]:
        first: dict[str, set] = {h: set() for h in heads} | {t: {t} for t in self.terminals}
        empty: set[str] = set()
        follow: dict[str, set] = {h: set() for h in heads}
        follow[self.start].add(END)
        size = -1
        while size != (size := sum(map(len, [*first.values(), *follow.values(), empty]))):
            for head, body in self.rules:
                behind = set(follow[head])
                for symbol in reversed(body):
                    if symbol in heads:
                        follow[symbol] |= behind
                    behind = first[symbol] | (behind if symbol in empty else set())
                if all(symbol in empty for symbol in body):
                    empty.add(head)
                for symbol in body:
                    first[head] |= first[symbol]
                    if symbol not in empty:
                        break
        return follow


class Stacks:
    """The shared stacks of a table: nodes are numbers, 0 is the empty stack."""

    def __init__(self, table: Table) -> None:
        self.table = table
        self.nodes: list[tuple[int, int]] = [(0, -1)]  # (top state, node below)
        self.number = {(0, -1): 0}
        self.shifts = lru_cache(None)(self._shifts)
        self._find_all()

    def _push(self, state: int, below: int) -> int:
        node = self.number.setdefault((state, below), len(self.nodes))
        if node == len(self.nodes):
            self.nodes.append((state, below))
        return node

    def _reduced(self, node: int, ahead: str) -> tuple[set[int], bool]:
        """All stacks that reductions lead to with ``ahead`` next, and whether one is a
        whole sequence."""
        found, todo, whole = {node}, [node], False
        for at in todo:
            for i in self.table.ends[self.nodes[at][0]]:
                head, body = self.table.rules[i]
                if ahead not in self.table.follow[head]:
                    continue
                below = at
                for _ in body:
                    below = self.nodes[below][1]
                if head == self.table.start:
                    whole |= below == 0
                    continue
                made = self._push(self.table.moves[self.nodes[below][0], head], below)
                if made not in found:
                    found.add(made)
                    todo.append(made)
        return found, whole

    def _shifts(self, node: int, symbol: str) -> tuple[int, ...]:
        tops = sorted(self._reduced(node, symbol)[0])
        moves = self.table.moves
        states = ((moves.get((self.nodes[at][0], symbol)), at) for at in tops)
        return tuple(self._push(state, at) for state, at in states if state is not None)

    def _find_all(self) -> None:
        """All stacks a sequence can lead to, what ends one, and which can do whatever
        another can."""
        found = [0]
        for node in found:
            for symbol in sorted(self.table.terminals):
                found += [n for n in self.shifts(node, symbol) if n not in found]
            if len(found) > MOST_STACKS:
                raise ValueError("the role grammar must be one of bounded stacks")
        self.whole = {node: self._reduced(node, END)[1] for node in found}
        pairs = {(x, y) for x in found for y in found if self.whole[y] or not self.whole[x]}
        size = 0
        while size != (size := len(pairs)):
            pairs = {(x, y) for x, y in pairs if self._follows(x, y, pairs)}
        self.covered_by = {x: [y for y in found if (x, y) in pairs and y != x] for x in found}

    def _follows(self, x: int, y: int, pairs: set) -> bool:
        return all(
            any((x1, y1) in pairs for y1 in self.shifts(y, symbol))
            for symbol in self.table.terminals
            for x1 in self.shifts(x, symbol)
        )


class Change:
    """What a row makes of the live stacks: the new ones, what is added to all costs, and
    for each new stack (letters added, roles added, which stack it came from)."""

    __slots__ = ("live", "base", "back")

    def __init__(self, live, base, back) -> None:
        self.live, self.base, self.back = live, base, back


class Repairer:
    """Cheapest repair of role sequences; ``repair`` is exact for any length."""

    def __init__(self, stacks: Stacks | None = None) -> None:
        self.stacks = stacks or Stacks(Table())
        self.changes: dict[tuple, Change] = {}
        self.first = self._settled([(0, "", 0, 0, "", 0)])

    def _settled(self, reached: list[tuple]) -> Change:
        """Merges what was reached, by node, with all inserts in front.

        An entry is (cost, letters added, rank behind, node, roles added, came from).
        """
        heapify(reached)
        best: dict[int, tuple] = {}
        while reached:
            entry = heappop(reached)
            cost, letters, rank, node, roles, origin = entry
            if node in best:
                continue
            best[node] = entry
            for role in WRITABLE:
                for after in self.stacks.shifts(node, role):
                    if after not in best:
                        heappush(
                            reached,
                            (cost + INSERT, "I" + letters, rank, after, role + roles, origin),
                        )
        covered_by = self.stacks.covered_by
        kept = [
            entry
            for node, entry in sorted(best.items())
            if not any(y in best and best[y][:3] < entry[:3] for y in covered_by[node])
        ]
        base = min(entry[0] for entry in kept)
        order = {key: i for i, key in enumerate(sorted({entry[1:3] for entry in kept}))}
        live = tuple((e[3], e[0] - base, order[e[1:3]]) for e in kept)
        return Change(live, base, [(e[1], e[4], e[5]) for e in kept])

    def _change(self, live: tuple, row: str) -> Change:
        role = row.lower()
        extra = TRUNCATED if row != role else 0
        reached = []
        for origin, (node, cost, rank) in enumerate(live):
            reached.append((cost + DELETE, "D", rank, node, "-", origin))
            if row == DOOMED:
                continue
            for letter, to, price in [("K", role, 0), *(("R", to, REROLE) for to in WRITABLE)]:
                for after in self.stacks.shifts(node, to):
                    reached.append((cost + price + extra, letter, rank, after, to, origin))
        return self._settled(reached)

    def repair(self, rows: str) -> tuple[int, str, str]:
        """(cost, audit, roles) of rows given as characters. The audit has a letter per
        edit in order (K, R, D, I) and ``roles`` what each leads to ('-' for deletes).
        Of equally cheap repairs the one with the ASCII-least audit is taken."""
        change, cost, path = self.first, self.first.base, [self.first]
        known = self.changes
        for row in reversed(rows):
            key = (change.live, row)
            change = known.get(key)
            if change is None:
                change = known[key] = self._change(*key)
            cost += change.base
            path.append(change)
        ends = [
            (added, rank, at)
            for at, (node, added, rank) in enumerate(change.live)
            if self.stacks.whole[node]
        ]
        added, _, at = min(ends)
        audit, roles = [], []
        for change in reversed(path):
            letters, made, at = change.back[at]
            audit.append(letters)
            roles.append(made)
        return cost + added, "".join(audit), "".join(roles)


@lru_cache(maxsize=1)
def repairer() -> Repairer:
    """One per worker process."""
    return Repairer()
