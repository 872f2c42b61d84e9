"""Column-name cleaning."""

from __future__ import annotations

import re
import unicodedata

# ASCII spelling of letters that have no decomposition.
# A letter that is absent here and does not decompose to ASCII is removed.
ASCII_SPELLING = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "io",
    "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k", "л": "l", "м": "m",
    "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u",
    "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch",
    "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "iu", "я": "ia",
    "є": "ie", "і": "i", "ї": "yi", "ґ": "g", "ў": "u",
    "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "ð": "d",
    "þ": "th", "ħ": "h", "ı": "i", "ŋ": "ng",
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th",
    "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p",
    "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps",
    "ω": "o",
    "ა": "a", "ბ": "b", "გ": "g", "დ": "d", "ე": "e", "ვ": "v", "ზ": "z", "თ": "t",
    "ი": "i", "კ": "k", "ლ": "l", "მ": "m", "ნ": "n", "ო": "o", "პ": "p", "ჟ": "zh",
    "რ": "r", "ს": "s", "ტ": "t", "უ": "u", "ფ": "p", "ქ": "k", "ღ": "g", "ყ": "q",
    "შ": "sh", "ჩ": "ch", "ც": "c", "ძ": "z", "წ": "c", "ჭ": "ch", "ხ": "x", "ჯ": "j",
    "ჰ": "h",
    "ա": "a", "բ": "b", "գ": "g", "դ": "d", "ե": "e", "զ": "z", "է": "e", "ը": "e",
    "թ": "t", "ժ": "zh", "ի": "i", "լ": "l", "խ": "kh", "ծ": "ts", "կ": "k", "հ": "h",
    "ձ": "dz", "ղ": "gh", "ճ": "ch", "մ": "m", "յ": "y", "ն": "n", "շ": "sh", "ո": "o",
    "չ": "ch", "պ": "p", "ջ": "j", "ռ": "r", "ս": "s", "վ": "v", "տ": "t", "ր": "r",
    "ց": "ts", "ւ": "w", "փ": "p", "ք": "k", "օ": "o", "ֆ": "f",
    "€": "EUR",
}

VALID_NAME = re.compile(r"[a-zA-Z_][a-zA-Z0-9_]*")


def to_ascii(text: str) -> str:
    """Spell text in ASCII letters as far as possible."""
    return "".join(map(_spelled, text)).encode("ascii", "ignore").decode()


def _spelled(ch: str) -> str:
    low = ch.lower()
    if low in ASCII_SPELLING:
        spelled = ASCII_SPELLING[low]
        return spelled if ch == low else spelled.capitalize()
    parts = unicodedata.normalize("NFKD", ch)
    # letters under marks and in other forms are spelled like the plain ones
    return "".join(map(_spelled, parts)) if parts != ch else ch


def clean_names(*names: str) -> list[str]:
    """Names usable as columns: ASCII letters, digits and ``_``, all different.

    Valid names stay. A name left empty becomes ``col_<position>``; a repeated
    one gets ``_1``, ``_2``, ... Repeats are found without regard to case, as
    Spark resolves columns that way.
    """
    cleaned: list[str] = []
    taken: set[str] = set()
    for position, name in enumerate(names):
        if not VALID_NAME.fullmatch(name):
            name = re.sub(r"[^a-zA-Z0-9_]", "", to_ascii(name))
        base = name or f"col_{position}"
        name, suffix = base, 0
        while name.lower() in taken:
            suffix += 1
            name = f"{base}_{suffix}"
        taken.add(name.lower())
        cleaned.append(name)
    return cleaned


def quoted(name: str) -> str:
    """A column name as an expression that means just this column."""
    return "`" + name.replace("`", "``") + "`"


def free_name(wanted: str, *taken: list[str]) -> str:
    """``wanted``, with marks put before it until no column has it."""
    used = {c.lower() for names in taken for c in names}
    while wanted.lower() in used:
        wanted = "_" + wanted
    return wanted
