"""Byte-pair merges as a finite-state transducer whose states are made when a text first needs them.

A prefix of the input has one encoding, and its last token is the only one that is stable behind the encoding
before it: a pair of tokens is stable when no merge ever crosses the border between them.  So after each
symbol a state holds, for every earlier border from which some token could still reach further, the part of a
token read since then, the tokens it may become, and the output that would come before it.  Output that all
borders share is emitted at once; the wait is bounded by the longest token.  States and transitions are
remembered (determinised lazily) and forgotten together when there are too many.  Answers about pairs of tokens
and about continuations stand in tables of fixed length, where a new answer takes the place of an older one.
"""

from __future__ import annotations

from array import array

#: States kept at a time, about 1 kB each with their transitions.
MAX_STATES = 120_000
#: Places for known pairs of tokens (8 bytes each) and for known continuations (about 200 bytes); powers of two.
PAIR_PLACES, AHEAD_PLACES = 1 << 20, 1 << 16
#: The tokens that may follow a border are only listed once there are no more than this.
LISTED = 12


class State(dict):
    """Transitions by symbol: (next state, ids to emit).  ``rest`` is what to emit at the end of the input."""

    __slots__ = ("machine", "borders", "rest")

    def __init__(self, machine: Transducer, borders: tuple):
        super().__init__()
        self.machine, self.borders = machine, borders
        self.rest = borders[-1][2]

    def __missing__(self, symbol: str):
        self[symbol] = result = self.machine.step(self.borders, symbol)
        return result


class Transducer:
    """Encodes strings of symbols by a vocabulary whose ids are in merge order, single symbols first."""

    def __init__(self, vocabulary: dict[str, int], max_states: int = MAX_STATES):
        self.vocabulary, self.max_states = vocabulary, max_states
        self.spelling = {i: s for s, i in vocabulary.items()}
        self.longer: dict[str, list[int]] = {}
        for spelling, token in vocabulary.items():
            for n in range(1, len(spelling)):
                self.longer.setdefault(spelling[:n], []).append(token)
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs = array("q", [-1]) * PAIR_PLACES  # the pair and, as the last bit, whether it is stable
        self.ahead: list[tuple[str, int, frozenset[int]] | None] = [None] * AHEAD_PLACES
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple, State] = {}
        self.start = State(self, (("", -1, ()),))

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a symbol, or for a token no merges make."""
        if token not in self.halves:
            parts = [self.vocabulary[c] for c in self.spelling[token]]
            while len(parts) > 2:
                merges = [(self.joined(a, b), n) for n, (a, b) in enumerate(zip(parts, parts[1:]))]
                best, at = min((m for m in merges if m[0] is not None), default=(token, 0))
                if best >= token:
                    break
                parts[at:at + 2] = [best]
            self.halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.halves[token]

    def joined(self, a: int, b: int) -> int | None:
        return self.vocabulary.get(self.spelling[a] + self.spelling[b])

    def stable(self, a: int, b: int) -> bool:
        """Whether the encoding of the two tokens' spellings is these two tokens."""
        pair = a << 31 | b
        place = (a * 40503 + b) & (PAIR_PLACES - 1)
        known = self.pairs[place]
        if known >> 1 != pair:
            known = self.pairs[place] = pair << 1 | self._stable(a, b)
        return bool(known & 1)

    def _stable(self, a: int, b: int) -> bool:
        before = 1 << 60  # merges from this rank on came too late to cross the border
        while True:
            across = self.joined(a, b)
            if across is not None and across < before:
                return False
            left, right = self.split(a), self.split(b)
            if left is None and right is None:
                return True
            if right is None or left is not None and a > b:  # undo the later merge; of equal ones, the right one
                before, a = a, left[1]
            else:
                before, b = b + 1, right[0]

    def possible(self, prefix: str, last: int) -> frozenset[int] | int:
        """The tokens beginning with a prefix that are stable behind the last token; that token if there are many."""
        if len(self.longer.get(prefix, ())) > LISTED:
            return last
        tokens = self.longer.get(prefix)
        if tokens is None:
            return frozenset()
        place = hash((prefix, last)) & (AHEAD_PLACES - 1)
        known = self.ahead[place]
        if known is None or known[1] != last or known[0] != prefix:
            possible = frozenset(t for t in tokens if self.usable(t) and (last < 0 or self.stable(last, t)))
            known = self.ahead[place] = prefix, last, possible
        return known[2]

    def usable(self, token: int) -> bool:
        return len(self.spelling[token]) == 1 or self.split(token) is not None

    def step(self, borders: tuple, symbol: str):
        """borders: (symbols since, last token or the tokens still possible, output), the latest last."""
        after, reached = [], None
        for since, known, output in borders:
            spelling = since + symbol
            token = self.vocabulary.get(spelling)
            if isinstance(known, frozenset):
                ends = token in known
                further = frozenset(t for t in known if t != token and self.spelling[t].startswith(spelling))
            else:
                ends = token is not None and self.usable(token) and (known < 0 or self.stable(known, token))
                further = self.possible(spelling, known)
            if ends:
                reached = token, (*output, token)
            if isinstance(further, int) or further:
                after.append((spelling, further, output))
        after.append(("", reached[0], reached[1]))
        outputs = [b[2] for b in after]
        common = 0
        while all(len(o) > common and o[common] == outputs[0][common] for o in outputs):
            common += 1
        borders = tuple((s, k, o[common:]) for s, k, o in after)
        state = self.states.get(borders)
        if state is None:
            if len(self.states) >= self.max_states:
                self.reset()
            state = self.states[borders] = State(self, borders)
        return state, outputs[0][:common]

    def encode(self, symbols) -> list[int]:
        state, out = self.start, []
        for symbol in symbols:
            state, emitted = state[symbol]
            if emitted:
                out += emitted
        out += state.rest
        return out
