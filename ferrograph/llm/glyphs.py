"""What a reader sees of a string: look-alikes, ignorables, dashes and blanks."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

# Letters of other alphabets that are drawn like a Latin letter (left) in print.
LOOK_ALIKES = {
    "A": "АΑᎪ", "B": "ВΒᏴ", "C": "СϹᏟ", "D": "Ꭰ", "E": "ЕΕᎬ", "F": "Ϝ", "G": "ԌᏀ", "H": "НΗᎻ", "I": "ІΙӀ",
    "J": "ЈͿᎫ", "K": "КΚᏦ", "L": "Ꮮ", "M": "МΜᎷ", "N": "Ν", "O": "ОΟՕ", "P": "РΡᏢ", "Q": "Ԛ", "R": "Ꮢ",
    "S": "ЅՏᏚ", "T": "ТΤᎢ", "U": "Ս", "V": "ѴᏙ", "W": "ԜᎳ", "X": "ХΧ", "Y": "ҮΥ", "Z": "ΖᏃ",
    "a": "аɑ", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡց", "h": "һհ", "i": "і", "j": "јϳ", "l": "ӏ",
    "n": "ո", "o": "оοօ", "p": "р", "q": "ԛ", "s": "ѕ", "u": "ս", "v": "ѵν", "w": "ԝ", "x": "х", "y": "у",
    "З": "Ʒ", "У": "Ꭹ",
}
# The same of the Lisu and Coptic letters; the Latin letter first.
LISU_AND_COPTIC = "AꓮⲀ BꓐⲂ CꓚⲤ Dꓓ EꓰⲈ Fꓝ Gꓖ HꓧⲎ IꓲⲒ Jꓙ KꓗⲔ Lꓡ MꓟⲘ NꓠⲚ OꓳⲞ PꓑⲢ Rꓣ Sꓢ TꓔⲦ Uꓴ Vꓦ Wꓪ XꓫⲬ YꓬⲨ Zꓜ cⲥ oⲟ pⲣ"
# Kana and ideographs drawn alike.
KANA_ALIKES = {"二": "ニ", "口": "ロ", "力": "カ", "工": "エ", "夕": "タ", "卜": "ト", "ヘ": "へ"}
#: Marks that have no width beside those of category Cf.
UNSEEN = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0000, 0xE01F0)}
#: Dashes outside category Pd, and members of Pd that are drawn differently.
MORE_DASHES, NO_DASHES = {0x2212, 0x2043, 0x02D7}, {0x301C, 0x3030, 0x30A0, 0x05BE, 0x1400, 0x1806, 0x2E17, 0x2E1A, 0x2E40}


class _Edges(dict):
    """What each code point counts as; one that isn't there counts as itself, and is then there: a look-up that misses is slow."""

    def __missing__(self, cp: int) -> str:
        self[cp] = c = chr(cp)
        return c


def _table() -> dict[int, str | None]:
    """Zero-cost edges; None for ignorables."""
    table: dict[int, str | None] = _Edges()
    for cp in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(cp))
        if kind == "Cf" or cp in UNSEEN:
            table[cp] = None
        elif kind == "Cc" or kind[0] == "Z":
            table[cp] = " " if chr(cp).isspace() else None
        elif (kind == "Pd" and cp not in NO_DASHES) or cp in MORE_DASHES:
            table[cp] = "-"
    for alikes in (LOOK_ALIKES, KANA_ALIKES, {x[0]: x[1:] for x in LISU_AND_COPTIC.split()}):
        for seen, others in alikes.items():
            table.update({ord(x): seen for x in others})
    return table


@lru_cache(1)
def zero_cost() -> dict[int, str | None]:
    return _table()


def glyphs(text: str) -> str:
    """The marks a reader sees, in order: decomposed, one style, one dash, one blank between words, none at the ends.

    Two strings read the same exactly if this is equal. An empty or blank text gives an empty string.
    """
    if text.isascii() and "  " not in text and text.isprintable():
        return text.strip(" ")
    return " ".join(unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", text).translate(zero_cost())).split())


#: Letters that belong to one script only once look-alikes are merged, for spelling an unmatched token.
_GREEK = {seen: x for seen, others in LOOK_ALIKES.items() for x in others if "Ͱ" <= x <= "Ͽ"}
_CYRILLIC = {seen: x for seen, others in LOOK_ALIKES.items() for x in others if "Ѐ" <= x <= "ԯ"}
_TOKEN = re.compile(r"[^ ]+")


def spell(token: str) -> str:
    """One spelling for the glyphs of a token: the script of its unmistakable letters decides the ambiguous ones."""
    if token.isascii():
        return token
    rest = [c for c in token if c.isalpha() and c not in _GREEK and c not in _CYRILLIC]
    if any("Ѐ" <= c <= "ԯ" for c in rest):
        token = "".join(_CYRILLIC.get(c, c) for c in token)
    elif any("Ͱ" <= c <= "Ͽ" for c in rest) and not any(c.isascii() for c in rest):
        token = "".join(_GREEK.get(c, c) for c in token)
    return unicodedata.normalize("NFC", token)


def spell_text(seen: str) -> str:
    return _TOKEN.sub(lambda m: spell(m[0]), seen)
