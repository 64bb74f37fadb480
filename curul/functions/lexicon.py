"""Reference lists as a trie searched with a Levenshtein automaton.

The automaton is the bit-parallel one: state j holds, as a bit set over the
positions of the query, what can be reached with j edits.  It is advanced along
the edges of the trie, so entries that share a beginning share the work, and a
branch is left when every state is empty.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import combinations, permutations

from curul.functions.unicode_text import fold, is_missing

# Words without meaning of their own in names of committees, topics and bodies.
LINK_WORDS = frozenset("y e de del la las el los a al con en para por".split())
# Contractions that aren't a beginning of their word.
CONTRACTIONS = {"hda": "hacienda", "mpal": "municipal", "mpales": "municipales", "admon": "administracion", "edo": "estado", "gral": "general", "nal": "nacional", "depto": "departamento", "gob": "gobernacion", "jta": "junta", "acdos": "acuerdos", "acdo": "acuerdo", "ayto": "ayuntamiento", "univ": "universidad", "nva": "nueva", "pdo": "partido", "fte": "frente", "mov": "movimiento", "gpo": "grupo", "trib": "tribunal"}


class Trie:
    """Strings with payloads. A payload is (entry id, penalty)."""

    def __init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[int, float]]] = [[]]
        self.below: list[dict[int, float]] = [{}]

    def add(self, text: str, entry: int, penalty: float = 0.0) -> None:
        at = 0
        for c in text:
            if c not in self.next[at]:
                self.next[at][c] = len(self.next)
                self.next.append({})
                self.ends.append([])
                self.below.append({})
            at = self.next[at][c]
            if penalty <= 1:
                self.below[at][entry] = min(penalty, self.below[at].get(entry, 9.0))
        self.ends[at].append((entry, penalty))

    def search(self, query: str, k: int, prefixes_from: int = 0, beginning: bool = False) -> list[tuple[float, int, str]]:
        """All (cost, entry, how) whose text is within k edits of the query; adjacent exchange counts as one edit.

        With ``prefixes_from`` > 0 a query of at least that length also matches an inner node under which a single
        entry lies (the typed value stops before the entry does). With ``beginning`` the answer is one place, or none,
        at which a text begins with something within k edits of the query.
        """
        n = len(query)
        mask: dict[str, int] = {}
        for i, c in enumerate(query):
            mask[c] = mask.get(c, 0) | 1 << i
        full, goal = (1 << (n + 1)) - 1, 1 << n
        start = []
        for j in range(k + 1):
            start.append((1 << (j + 1)) - 1 & full)
        found: list[tuple[float, int, str]] = []
        stack = [(0, start, [0] * (k + 1), "")]
        while stack:
            node, rows, swaps, last = stack.pop()
            best = next((j for j, r in enumerate(rows) if r & goal), None)
            if best is not None and beginning:
                return [(float(best), -1, "beginning")]
            if best is not None:
                found += [(best + p, e, "entry" if p == 0 else "alias") for e, p in self.ends[node]]
                if prefixes_from and n >= prefixes_from and node and self.next[node] and self.below[node]:
                    least = min(self.below[node].values())
                    under = [e for e, p in self.below[node].items() if p == least]
                    if len(under) == 1:
                        found.append((best + 0.5 + least, under[0], "cut"))
            for c, to in self.next[node].items():
                m = mask.get(c, 0) << 1
                new: list[int] = []
                for j in range(k + 1):
                    r = (rows[j] << 1) & m
                    if j:
                        r |= rows[j - 1] | (rows[j - 1] << 1) | (new[j - 1] << 1)
                        if swaps[j - 1]:
                            r |= swaps[j - 1] & (mask.get(last, 0) << 1)
                    new.append(r & full)
                if any(new):
                    # where an exchange of c and its follower would end: the query has the follower first, then c
                    nxt = [((r & (mask.get(c, 0) >> 1)) << 2) & full for r in rows]
                    stack.append((to, new, nxt, c))
        return found


def edits_allowed(n: int) -> int:
    """Edits tolerated in a value of n letters."""
    return 0 if n <= 3 else 1 if n <= 7 else 2 if n <= 14 else 3 if n <= 24 else 4


_LEAD = re.compile(r"^(?:(?:a la |de la |la )?(?:comision|comisiones|comite|com|c)\b[. ]*(?:de |del |para )?(?:la |las |el |los )?|tema[: ]+)")


class Catalog:
    """A small reference list (id, text) that answers with all entries near a typed value.

    Meant for lists of a checked size: more than ``limit`` entries raise, since the list is sent to every worker.
    Alias paths of an entry: its halves around "y" exchanged, and the entry less one word where that still names
    one entry only; with ``any_order`` also its words in any order.
    """

    def __init__(self, entries: list[tuple[int, str]], numbered: bool = False, limit: int = 20_000, lead: bool = True, aliases: list[tuple[int, str]] = (), any_order: bool = False) -> None:  # type: ignore[assignment]
        if len(entries) > limit:
            raise ValueError(f"{len(entries)} entries; a broadcast list may have {limit}")
        self.numbered, self.lead = numbered, lead
        self.exact = {t: i for i, t in entries}
        self.ids = {i for i, _ in entries}
        self.trie = Trie()
        self.words: set[str] = set()
        claimed: dict[str, set[int]] = {}
        weak: list[tuple[str, int, float]] = []
        for i, t in [*entries, *aliases]:
            key = self.key(t)
            self.words.update(key.split())
            claimed.setdefault(key, set()).add(i)
            self.trie.add(key, i)
            halves = re.split(r"\s+[ye]\s+", fold(t))
            for cut in range(1, len(halves)):
                turned = self.key(" y ".join([" y ".join(halves[cut:]), " y ".join(halves[:cut])]))
                self.trie.add(turned, i)
                weak += self._shorter(turned, i)
            weak += self._shorter(key, i)
            if any_order and 1 < len(key.split()) <= 4:
                for p in permutations(key.split()):
                    self.trie.add(" ".join(p), i, 0.2 if " ".join(p) != key else 0.0)
        by: dict[str, set[int]] = {}
        for s, i, _ in weak:
            by.setdefault(s, set()).add(i)
        for s, i, p in dict.fromkeys(weak):
            if len(by[s]) == 1 and not claimed.get(s, set()) - {i}:
                self.trie.add(s, i, p)

    @staticmethod
    def _shorter(key: str, i: int) -> list[tuple[str, int, float]]:
        ws = key.split()
        return [(" ".join(w for k, w in enumerate(ws) if k != d), i, 1.0) for d in range(len(ws)) if len(ws) > 1] + [(" ".join(w for k, w in enumerate(ws) if k not in d), i, 2.0) for d in combinations(range(len(ws)), 2) if len(ws) > 3]

    def key(self, text: str) -> str:
        t = re.sub(r"[&/+]", " y ", fold(text))
        t = re.sub(r",\s*a\.?\s*[pc]\.?\s*$", "", t)  # ", A.P." and the like
        if self.lead:
            t = re.sub(r"[^a-z0-9.: ]+", " ", t).strip()
            while (u := _LEAD.sub("", t, count=1).strip()) != t and u:
                t = u
            t = re.sub(r"\b[yeo] c\. ", " y ", t)
        t = re.sub(r"[^a-z0-9 ]+", " ", t)
        letters = t.split()
        if len(letters) > 1 and all(len(w) == 1 for w in letters):
            return "".join(letters)
        ws = [w for w in letters if w not in LINK_WORDS]
        if self.lead:  # a misspelt heading, wherever a turned name has it
            ws = [w for w in ws if w in self.words or not _like_heading(w)] or ws
        return " ".join(ws)

    def _expand(self, text: str) -> list[str]:
        """All readings of a typed value in which short forms are written out by the words of the list, less such as are
        beyond the distance from every text of the list by their beginning."""
        t = re.sub(r"[&/+]", " y ", fold(text))
        dotted = {w for w in re.findall(r"([a-z]+)\.", t)}
        words = self.key(text).split()
        ways: list[list[str]] = []
        for w in words:
            if w in self.words:
                opts = [w]
            elif w in CONTRACTIONS and CONTRACTIONS[w] in self.words:
                opts = [CONTRACTIONS[w]]
            elif w in dotted and len(w) <= 8:
                opts = sorted(v for v in self.words if v.startswith(w)) or [
                    *sorted(v for v in self.words if v[0] == w[0] and _within(w, v)),
                    *sorted((v for v in self.words if len(w) > 2 and len(v) > len(w) and v[0] == w[0] and levenshtein(w, v[: len(w)], 2) <= (1 if len(w) < 4 else 2)), key=lambda v: (levenshtein(w, v[: len(w)]), v)),
                ] or [w]
            elif len(w) >= 5 and (longer := sorted(v for v in self.words if v.startswith(w))):
                opts = [w, *longer]
            else:
                opts = [w]
            if w not in self.words and w not in dotted and (w in _HEADS or len(w) <= 5 and _like_link(w)):
                opts = [*opts, ""]
            ways.append(list(dict.fromkeys(opts)))
        k = edits_allowed(sum(max(map(len, opts)) + 1 for opts in ways) - 1)
        out = [""]
        for opts in ways:
            out = list(dict.fromkeys(f"{o} {x}".strip() for o in out for x in opts))
            if len(out) > 64:  # those that no text of the list begins like can't come near one
                out = [o for o in out if self.trie.search(o, k, beginning=True)]
        return out

    def number(self, text: str) -> int | None:
        m = re.fullmatch(r"[\s(\[#]*(?:tema|no|num)?[.:\s]*0*(\d{1,4})(?:\.0+)?[\s.)\]-]*", fold(text))
        return int(m.group(1)) if m else None

    def near(self, text: str | None) -> list[tuple[float, int, str]]:
        """All (cost, id, how) within the distance its length allows, nearest first; [] when missing."""
        if is_missing(text):
            return []
        if text in self.exact:
            return [(0.0, self.exact[text], "exact")]
        if self.numbered:
            n = self.number(text)
            if n is not None:
                return [(0.0, n, "number")] if n in self.ids else []
            rest = text
            while (m := re.match(r"\s*(?:tema[\s:.]*)?[(\[#]*\d{1,4}(?:\.0+)?\s*[.)\]:-]+[\s-]*(?=\D)", rest, re.I)) and len(rest) > m.end():
                rest = rest[m.end():]
            text = rest
        best: dict[int, tuple[float, str]] = {}
        inner = re.sub(r"\([^()]*\)", " ", text)
        for q in [*self._expand(text), *(self._expand(inner) if inner.strip() and inner != text else [])]:
            q = q.replace("  ", " ").strip()
            if len(q) < 3:
                continue
            k = edits_allowed(len(q))
            for cost, e, how in self.trie.search(q, k, prefixes_from=4):
                if how == "alias" and cost > max(k, 1) + 1 or how == "cut" and cost > max(1.0, k - 0.5):
                    continue
                if e not in best or cost < best[e][0]:
                    best[e] = (cost, how)
        return sorted((c, e, h) for e, (c, h) in best.items())

    def best(self, text: str | None) -> tuple[int | None, str]:
        """(id, how); (-1, "none") when no entry is meant, (None, "missing") when there is no value."""
        return self.decide(text, self.near(text))

    @staticmethod
    def decide(text: str | None, c: list[tuple[float, int, str]]) -> tuple[int | None, str]:
        """The answer of ``best`` from that of ``near``."""
        if not c and is_missing(text):
            return None, "missing"
        if not c:
            return -1, "none"
        if len(c) > 1 and c[0][0] == c[1][0] and c[0][2] == "cut":
            return -1, "ambiguous"
        return c[0][1], c[0][2]


# Headings that stand before entries of a reference list and name none.
_HEADS = ("tema", "comision", "com")


@lru_cache(maxsize=100_000)
def _like_heading(w: str) -> bool:
    return len(w) >= 6 and any(len(h) >= 6 and levenshtein(w, h, 2) <= 2 for h in _HEADS)


@lru_cache(maxsize=10_000)
def _like_link(w: str) -> bool:
    """A misspelt link word or heading."""
    return any(levenshtein(w, v, 2) <= (1 if len(v) < 3 else 2 if len(w) > 4 else 1) or sorted(w) == sorted(v) for v in [*LINK_WORDS, "tema"] if len(v) > 1)


def _within(short: str, long: str) -> bool:
    it = iter(long)
    return len(short) >= 2 and short[-1] in (long[-1], long[-2:][0]) and all(c in it for c in short)


@lru_cache(maxsize=200_000)
def levenshtein(a: str, b: str, most: int = 99) -> int:
    """Edit distance (a true metric); ``most`` + 1 when it is beyond that."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        if min(cur) > most:
            return most + 1
        prev = cur
    return prev[-1]
