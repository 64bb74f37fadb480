"""Canonical Unicode form with a quick-check, as plain Python.

A text is *stable* when no character is invisible, an odd space, a separate
accent, a compatibility shape of a letter, digit or sign, or a look-alike from
another alphabet.  ``canonical`` isolates the unstable stretches, extends each
to the word around it (the boundary context that composition and the look-alike
decision need), rewrites only those and splices them into the unchanged rest.
"""

from __future__ import annotations

import re
import unicodedata as ud
from functools import lru_cache

# Letters of other alphabets and the Latin letter each looks like.
CYRILLIC_LOOKS = dict(zip("асеорхуіјѕһԁԛԝкмтвнАВЕКМНОРСТХУІЈЅԚԜҮ", "aceopxyijshdqwkmtbhABEKMHOPCTXYIJSQWY"))
GREEK_LOOKS = dict(zip("οανικυρτγχΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϲϳ", "oavikuptyxABEZHIKMNOPTYXCcj"))
ARMENIAN_LOOKS = dict(zip("օսոհցՍՕ", "ounhgUO"))
LATIN_LOOKS = dict(zip("ıɑɡǀƖⲟ", "iaglIo"))
SIGN_LOOKS = {";": ";", "․": ".", "∶": ":", "꞉": ":", "⁄": "/", "∕": "/", "ǃ": "!", "։": ":", "‚": ",", "ʼ": "'", "∣": "|", "∗": "*"}
TYPOGRAPHIC = set("«»“”„‘’‹›…–—―‐‑‒−·•º°ª²³¹½¼¾¿¡´¨€§©®™№")
EXTRA_INVISIBLE = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180E, 0x2800, 0x3164, 0xFFA0}

LOOKS = {**CYRILLIC_LOOKS, **GREEK_LOOKS, **ARMENIAN_LOOKS, **LATIN_LOOKS}
#: What the quick-check of a whole value accepts without looking closer; Java and Python read it alike.
STABLE_CLASS = r"\x00-\x7E¡-§©-¬®°-ÿ–-―‘’“”…"
UNSTABLE = rf"[^{STABLE_CLASS}]"
_UNSTABLE_RE = re.compile(UNSTABLE)


def _is_invisible(c: str) -> bool:
    o = ord(c)
    return ud.category(c) == "Cf" or o in EXTRA_INVISIBLE or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o <= 0xE01EF


@lru_cache(maxsize=65536)
def char_class(c: str) -> tuple[str, str]:
    """(kind, replacement). kind: ok, invisible, space, accent, shape (always wrong) or look (wrong by context)."""
    if c == " " or (c < "\x7f") or c in TYPOGRAPHIC:
        return "ok", c
    if _is_invisible(c):
        return "invisible", ""
    cat = ud.category(c)
    if cat == "Zs":
        return "space", " "
    if cat in ("Mn", "Me"):
        return "accent", c
    if c in SIGN_LOOKS:
        return "shape", SIGN_LOOKS[c]
    dec = ud.decomposition(c)
    if dec.startswith("<"):
        tag = dec[1:].split(">")[0]
        plain = ud.normalize("NFKC", c)
        if tag in ("wide", "narrow", "font", "circle") or tag == "compat" and cat[0] in "LN":
            return "shape", plain
        return "ok", c
    if dec and " " not in dec and cat[0] in "LPS":  # singletons such as the Kelvin sign
        return "shape", ud.normalize("NFC", c)
    if cat == "Nd":
        return "shape", str(ud.digit(c))
    if c in LATIN_LOOKS:
        return "shape", LATIN_LOOKS[c]
    if cat[0] == "L" and not ud.name(c, "").startswith("LATIN"):
        return "look", LOOKS.get(ud.normalize("NFD", c)[0], "")
    return "ok", c


def _word_bounds(text: str, i: int) -> tuple[int, int]:
    inside = lambda c: c.isalnum() or ud.category(c) in ("Mn", "Me") or _is_invisible(c) or ud.category(c) == "Nl"
    a = b = i
    while a > 0 and inside(text[a - 1]):
        a -= 1
    while b < len(text) and inside(text[b]):
        b += 1
    return a, max(b, i + 1)


def _fix_segment(seg: str) -> tuple[str, bool]:
    """One word (or single sign): its canonical form and whether it needed it."""
    kinds = [char_class(c) for c in seg]
    letters = [(c, k, r) for c, (k, r) in zip(seg, kinds) if c.isalpha() and k in ("ok", "look", "shape")]
    foreign = [(c, r) for c, k, r in letters if k == "look"]
    mixed = len(foreign) < len(letters) or len({ud.name(c, "?").split()[0] for c, _ in foreign}) > 1
    swap = bool(foreign) and (mixed or all(r for _, r in foreign))
    out, dirty = [], False
    for c, (k, r) in zip(seg, kinds):
        if k in ("invisible", "space", "shape"):
            out.append(r)
            dirty = True
        elif k == "accent":
            out.append(c)
            dirty = True
        elif k == "look" and swap and r:
            marks = ud.normalize("NFD", c)[1:]
            out.append(r + marks)
            dirty = True
        else:
            out.append(c)
    return (ud.normalize("NFC", "".join(out)) if dirty else seg), dirty


def canonical(text: str | None) -> tuple[str | None, bool]:
    """(canonical text, whether any character needed it). None gives (None, False)."""
    if text is None:
        return None, False
    if not _UNSTABLE_RE.search(text):
        return text, False
    out, at, dirty, n = [], 0, False, len(text)
    while True:
        m = _UNSTABLE_RE.search(text, at)
        if not m:
            out.append(text[at:])
            break
        a, b = _word_bounds(text, m.start())
        a = max(a, at)
        if ud.category(text[m.start()]) in ("Mn", "Me") and a == m.start() and a > at:
            a -= 1
        seg, bad = _fix_segment(text[a:b])
        out.append(text[at:a])
        out.append(seg)
        dirty |= bad
        at = b
        if at >= n:
            break
    return "".join(out), dirty


def fold(text: str | None) -> str:
    """Canonical, lower-case, no accents (ñ becomes n); None gives ''."""
    if not text:
        return ""
    if text.isascii():
        return text.lower()
    text = canonical(text)[0].lower()
    return text if text.isascii() else "".join(c for c in ud.normalize("NFD", text) if not ud.combining(c))


# Words and abbreviations that say that there is no value.
MISSING_WORDS = ("none", "null", "nan", "nil", "na", "nd", "sd", "si", "no aplica", "no aplicable", "sin dato", "sin datos", "sin informacion", "no disponible", "no data", "not applicable", "ninguno", "ninguna", "nulo", "vacio", "s n", "n a", "n d", "s d", "s i", "no hay", "sin valor", "no hay datos", "no especificado", "sin especificar", "no determinado")
_MISSING = frozenset(MISSING_WORDS)


def is_missing(text: str | None) -> bool:
    """Null, blank, only dashes, or a word or abbreviation that says so."""
    if text is None:
        return True
    t = fold(text).strip()
    if not t.strip(" -–—_"):
        return True
    t = re.sub(r"[^a-z0-9]+", " ", t).strip()
    return t in _MISSING or t.replace(" ", "") in ("na", "nd", "sd") and len(t) <= 5
