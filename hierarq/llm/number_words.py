"""Numbers from 0 to 99 as people write them, in English, Spanish, Chinese and Vietnamese.

Words are composed from the languages' units, teens and tens by their rules. Text comes in lower
case without accents (``plain`` of the value mapping).
"""

from __future__ import annotations

import re

# Number words by language, from 0; accents are left out.
ENGLISH = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
           "nineteen").split()
ENGLISH_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
SPANISH = "cero uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince".split()
SPANISH_TENS = "veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa".split()
VIETNAMESE = "khong mot hai ba bon nam sau bay tam chin muoi".split()
CHINESE = "零一二三四五六七八九"
BIRTH = ["birth", "newborn", "newborns", "nacimiento"]

WORDS: dict[str, int] = {w: i for i, w in enumerate(ENGLISH)} | {w: i for i, w in enumerate(SPANISH)} | dict.fromkeys(BIRTH, 0)
WORDS |= {"un": 1, "una": 1, "veintiun": 21, "veintiuna": 21}
TENS: dict[str, int] = {w: 10 * i for i, w in enumerate(ENGLISH_TENS, 2)} | {w: 10 * i for i, w in enumerate(SPANISH_TENS, 2)}
WORDS |= {f"dieci{w}": 10 + i for i, w in enumerate(SPANISH) if 6 <= i <= 9} | {f"veinti{w}": 20 + i for i, w in enumerate(SPANISH) if 1 <= i <= 9}
WORDS |= {t + u: v + i for t, v in TENS.items() if t in ENGLISH_TENS for i, u in enumerate(ENGLISH) if 1 <= i <= 9}
#: In Vietnamese a unit after a ten may be written otherwise.
_VI = {w: i for i, w in enumerate(VIETNAMESE)}
_VI_AFTER_TEN = _VI | {"mot": 1, "tu": 4, "lam": 5, "nham": 5}
_VI_UNITS = ("thang", "tuoi")


def chinese(text: str) -> str:
    """Chinese numerals as digits, units and ranges as words that the other languages have."""
    if not re.search(r"[一-鿿]", text):
        return text
    text = text.replace("〇", "零").replace("两", "二").replace("兩", "二")

    def number(m: re.Match) -> str:
        tens, ten, ones = m.group(1), m.group(2), m.group(3)
        if ten:
            return str(10 * (CHINESE.index(tens) if tens else 1) + (CHINESE.index(ones) if ones else 0))
        return "".join(str(CHINESE.index(c)) for c in m.group())

    text = re.sub(f"([{CHINESE}]?)(十)([{CHINESE}]?)|[{CHINESE}]+", number, text)
    text = re.sub(r"(\d+)\s*(个月|個月|月龄|月齡|月|周岁|週歲|岁|歲)半", r"\1.5\2", text)
    text = re.sub(r"(\d+)\s*半", r"\1.5", text)
    for words, meaning in (("新生儿|新生兒|初生|出生", " birth "), ("个月大|個月大|个月|個月|月龄|月齡|月", " months "), ("周岁|週歲|岁|歲", " years "),
                           ("至|到|～", " to "), ("从|從|由", " from ")):
        text = re.sub(words, meaning, text)
    return re.sub(r"(\d+(?:\.\d+)? (?:months|years) *)(?:之前|以前|前)", r"by \1", text)


def vietnamese(tokens: list[str]) -> list[str]:
    """Vietnamese number words as digits and units as English ones, where a Vietnamese unit stands."""
    if not any(w in _VI_UNITS for w in tokens):
        return tokens
    out: list[str] = []
    i = 0
    while i < len(tokens):
        w, ahead = tokens[i], tokens[i + 1] if i + 1 < len(tokens) else ""
        number = bool(out) and out[-1].replace(".", "").isdigit()
        if w == "nam" and number:
            out.append("years")
        elif w == "ruoi" and number:
            out[-1] += ".5"
        elif w == "ruoi" and len(out) > 1 and out[-1] in ("years", "months") and out[-2].isdigit():
            out[-2] += ".5"
        elif w in _VI_UNITS:
            if not (w == "tuoi" and out and out[-1] in ("years", "months")):  # "24 thang tuoi": months of age
                out.append("months" if w == "thang" else "years")
        elif w == "so" and ahead == "sinh":
            out.append("birth")
            i += 1
        elif w in ("đen", "toi"):
            out.append("to")
        elif w == "tu":
            out.append("from")
        elif w in ("truoc",):
            out.append("by")
        elif w in _VI:
            n = _VI[w]
            if n < 10 and ahead == "muoi":
                n, i = 10 * n, i + 1
                ahead = tokens[i + 1] if i + 1 < len(tokens) else ""
            if n >= 10 and ahead in _VI_AFTER_TEN and _VI_AFTER_TEN[ahead] < 10 and not (ahead == "nam" and not _unit_follows(tokens, i + 2)):
                n, i = n + _VI_AFTER_TEN[ahead], i + 1
            out.append(str(n))
        else:
            out.append(w)
        i += 1
    return out


def _unit_follows(tokens: list[str], i: int) -> bool:
    return i < len(tokens) and tokens[i] in (*_VI_UNITS, "nam", "đen", "toi", "-")
