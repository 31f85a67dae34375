"""How many guesses a password withstands: the cheapest way to spell it from words, dates, repeats, keyboard walks, sequences and
plain characters, found by dynamic programming over its places.

Words come from a short list, the commonest in passwords first, and from a longer one that a corpus gives. Time grows with the
length of a value, whatever it holds: words and dates are bounded, and a repeat, walk or sequence, which may end anywhere
up to where it breaks off, is one offer that all those ends look at.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Mapping, Sequence

#: Common words of passwords, code and placeholders, the commonest first; a word's guesses grow with its place here.
WORDS = tuple(
    """password secret token key api your access value config get here env admin user pass login name example test the
    default set placeholder environ process database client server manager service account auth credentials data change
    changeme enter insert none null true false hidden redacted removed private public hash file path url root system app
    application prod production stage staging dev local localhost demo sample dummy todo string text type field param
    request response header session settings options welcome letmein dragon master monkey shadow sunshine princess
    football baseball qwerty iloveyou trustno superman batman hello freedom whatever ninja mustang flower summer winter
    spring autumn monday friday january february march april june july august september october november december guest
    company home work love money happy cookie cheese pepper orange banana apple chocolate coffee house family friend
    michael daniel jordan thomas robert jessica ashley charlie hunter killer soccer hockey guitar silver golden purple
    yellow green black white blue red star moon secure security safe open close start stop power magic lucky angel tiger
    lion eagle phoenix thunder matrix computer internet network phone email google amazon and for with this that from
    foo bar baz abc""".split()
)
LONGEST = 20
#: Digits and signs that stand for letters.
SAID_AS = str.maketrans("4@301!|$57", "aaeoiiisst")
#: Rows of a keyboard; neighbours on a row, or one above the other, make a walk.
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
PLACE = {c: (x + 0.5 * y, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
DATES = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d"
)
#: Runs of characters of one kind.
KINDS = re.compile(r"[a-zß-öø-ÿ]+|[A-ZÀ-ÖØ-Þ]+|[0-9]+|[-_./:@+=]|[^\W_]+|.", re.DOTALL)
#: Logarithms to 10 of guesses: for going on after a part that isn't plain, for a character that parts words, for a digit, for a letter of
#: a run that may be a word of some language, and for any other character.
JOIN, PARTING, DIGIT, SPOKEN, ODD = math.log10(2), 0.3, 1.0, 0.7, 1.3
#: Letters of one case from which on a run may be a word.
RUN = 3
#: Guesses for a repeat besides those for the place it repeats, for a walk at all and for each key of it, and for a sequence.
REPEAT, WALK, KEY, SEQUENCE = 1.0, math.log10(47 * 4), 0.35, math.log10(36 * 10)
#: Least lengths of words, repeats, walks and sequences.
LEAST_WORD, LEAST_REPEAT, LEAST_WALK, LEAST_SEQUENCE = 3, 3, 4, 3


def ranked(learned: Sequence[str] = ()) -> dict[str, int]:
    """Words with their rank: WORDS, then those that a corpus gives."""
    return {word: place for place, word in reversed(list(enumerate([*WORDS, *learned], 1)))}


def _adjacent(a: str, b: str) -> bool:
    p, q = PLACE.get(a.lower()), PLACE.get(b.lower())
    return p is not None and q is not None and a.lower() != b.lower() and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


def _follows(a: str, b: str) -> bool:
    return abs(ord(b) - ord(a)) == 1 and a.isalnum() and b.isalnum()


def _reach(value: str, joined) -> list[int]:
    """For each place the end of the stretch from there on in which neighbours are `joined`."""
    ends = list(range(1, len(value) + 1))
    for i in reversed(range(len(value) - 1)):
        if joined(value[i], value[i + 1]):
            ends[i] = ends[i + 1]
    return ends


def plain_costs(value: str) -> list[float]:
    """For each character the guesses it takes by itself, by the kind of the run that it stands in."""
    costs = []
    for match in KINDS.finditer(value):
        run = match[0]
        if run[0].isdigit():
            cost = DIGIT
        elif run[0].isalpha():
            cost = SPOKEN if len(run) >= RUN else ODD
        else:
            cost = PARTING if run in "-_./:@+=" else ODD
        costs += [cost] * len(run)
    return costs


def repeats(value: str) -> list[tuple[int, int, int]]:
    """(start, end, distance): stretches that stand `distance` places earlier as well, where the same three characters stood last.

    A stretch may overlap what it repeats, as in "abcabcabc". A start within one goes on with it.
    """
    last: dict[str, int] = {}
    found = []
    end = distance = 0
    for start in range(len(value) - LEAST_REPEAT + 1):
        three = value[start : start + LEAST_REPEAT]
        earlier = last.get(three)
        last[three] = start
        if end - start < LEAST_REPEAT:
            if earlier is None:
                continue
            end, distance = start + LEAST_REPEAT, start - earlier
            while end < len(value) and value[end] == value[end - distance]:
                end += 1
        found.append((start, end, distance))
    return found


class Guesser:
    """Guess costs by the words of a list; results of short values are remembered."""

    REMEMBERED, SHORT = 50_000, 200

    def __init__(self, learned: Sequence[str] = ()):
        self.rank = ranked(learned)
        self.known: dict[str, float] = {}

    def word(self, text: str) -> float | None:
        """log10 of the guesses for `text` as a known word with capitals and signs for letters."""
        low = text.lower()
        rank, said = self.rank.get(low), 0.0
        if rank is None:
            rank, said = self.rank.get(low.translate(SAID_AS)), 1.0
        if rank is None:
            return None
        capitals = sum(c.isupper() for c in text)
        variants = 0.0 if capitals == 0 else 0.3 if capitals == len(text) or (capitals == 1 and text[0].isupper()) else 1.0
        return math.log10(rank) + said + variants

    def log_guesses(self, value: str) -> float:
        """log10 of the guesses that the cheapest segmentation of `value` takes."""
        cost = self.known.get(value)
        if cost is None:
            cost = self._cheapest(value)
            if len(value) <= self.SHORT:
                if len(self.known) >= self.REMEMBERED:
                    self.known.clear()
                self.known[value] = cost
        return cost

    def _cheapest(self, value: str) -> float:
        size, plain = len(value), plain_costs(value)
        best = [0.0] * (size + 1)
        # Parts with one end, by their end; and by the first end they may have, those that may end at any place up to a limit.
        parts: dict[int, list[tuple[int, float]]] = {}
        offers: dict[int, list[tuple[int, int, float, float]]] = {}
        for start in range(size):
            for end in range(start + LEAST_WORD, min(size, start + LONGEST) + 1):
                cost = self.word(value[start:end])
                if cost is not None:
                    parts.setdefault(end, []).append((start, cost))
            date = DATES.match(value, start)
            if date:
                days = 119 if date.end() - start == 4 else 119 * 365
                parts.setdefault(date.end(), []).append((start, math.log10(days)))
        for start, limit, distance in repeats(value):
            offers.setdefault(start + LEAST_REPEAT, []).append((start, limit, REPEAT + math.log10(distance + 1), 0.0))
        for joined, least, cost, key in ((_adjacent, LEAST_WALK, WALK, KEY), (_follows, LEAST_SEQUENCE, SEQUENCE, 0.0)):
            for start, limit in enumerate(_reach(value, joined)):
                if limit - start >= least:
                    offers.setdefault(start + least, []).append((start, limit, cost, key))
        open_offers: dict[float, list[tuple[float, int]]] = {0.0: [], KEY: []}
        for end in range(1, size + 1):
            least = best[end - 1] + plain[end - 1]
            for start, cost in parts.get(end, ()):
                least = min(least, best[start] + cost + (JOIN if start else 0.0))
            for start, limit, cost, key in offers.get(end, ()):
                heapq.heappush(open_offers[key], (best[start] + cost - key * start + (JOIN if start else 0.0), limit))
            for key, waiting in open_offers.items():
                while waiting and waiting[0][1] < end:
                    heapq.heappop(waiting)
                if waiting:
                    least = min(least, waiting[0][0] + key * end)
            best[end] = least
        return best[size]


def log_guesses(value: str, ranks: Mapping[str, int] | None = None) -> float:
    """With WORDS alone, or the words of `ranks`."""
    guesser = Guesser()
    if ranks is not None:
        guesser.rank = dict(ranks)
    return guesser.log_guesses(value)
