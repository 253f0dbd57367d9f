"""English stems by the published Porter2 (Snowball English) algorithm, for a token at a time."""

from __future__ import annotations

import re
from functools import lru_cache

# Fixed values of the algorithm: exceptional forms, suffix lists, and the stop words of the English text search.
WHOLE = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"}
UNCHANGED = {"sky", "news", "howe", "atlas", "cosmos", "bias", "andes"}
AFTER_1A = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "fulli": "ful", "lessli": "less"}
STEP3 = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize")
STOP = frozenset("i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs themselves what which who whom this that these those am is are was were be been being have has had having do does did doing a an the and but if or because as until while of at by for with about against between into through during before after above below to from up down in out on off over under again further then once here there when where why how all any both each few more most other some such no nor not only own same so than too very s t can will just don should now".split())

_V = "aeiouy"
_DOUBLE = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")


def _regions(w: str) -> tuple[int, int]:
    def after(start: int) -> int:
        m = re.compile(f"[{_V}][^{_V}]").search(w, start)
        return m.end() if m else len(w)

    r1 = next((len(p) for p in ("gener", "commun", "arsen") if w.startswith(p)), None)
    r1 = after(0) if r1 is None else r1
    return r1, after(r1)


def _short_end(w: str) -> bool:
    return bool(re.search(f"[^{_V}][{_V}][^{_V}wxY]$", w)) or bool(re.fullmatch(f"[{_V}][^{_V}]", w))


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    w = word.lower().replace("’", "'")
    if len(w) <= 2:
        return w
    if w in WHOLE:
        return WHOLE[w]
    if w in UNCHANGED:
        return w
    w = w.lstrip("'")
    w = re.sub(f"^y|(?<=[{_V}])y", "Y", w)
    r1, r2 = _regions(w)
    w = re.sub(r"('s'|'s|')$", "", w)
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and re.search(f"[{_V}].", w[:-1]):
        w = w[:-1]
    if w in AFTER_1A:
        return w
    m = re.search(r"(eedly|eed|ingly|edly|ing|ed)$", w)
    if m and m[1] in ("eed", "eedly"):
        if m.start() >= r1:
            w = w[: m.start()] + "ee"
    elif m and re.search(f"[{_V}]", w[: m.start()]):
        w = w[: m.start()]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif w.endswith(_DOUBLE):
            w = w[:-1]
        elif r1 >= len(w) and _short_end(w):
            w += "e"
    w = re.sub(f"(?<=.[^{_V}])[yY]$", "i", w)
    m = re.search("(" + "|".join(sorted([*STEP2, "ogi", "li"], key=len, reverse=True)) + ")$", w)
    if m and m.start() >= r1:
        head, tail = w[: m.start()], m[1]
        if tail in STEP2:
            w = head + STEP2[tail]
        elif tail == "ogi" and head.endswith("l"):
            w = head + "og"
        elif tail == "li" and head[-1:] and head[-1] in "cdeghkmnrt":
            w = head
    m = re.search("(" + "|".join(sorted([*STEP3, "ative"], key=len, reverse=True)) + ")$", w)
    if m and m.start() >= r1:
        if m[1] in STEP3:
            w = w[: m.start()] + STEP3[m[1]]
        elif m.start() >= r2:
            w = w[: m.start()]
    m = re.search("(" + "|".join(sorted([*STEP4, "ion"], key=len, reverse=True)) + ")$", w)
    if m and m.start() >= r2 and (m[1] != "ion" or w[: m.start()].endswith(("s", "t"))):
        w = w[: m.start()]
    if w.endswith("e") and (len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_end(w[:-1]))):
        w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.lower()
