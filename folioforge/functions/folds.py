"""Text operations whose steps depend on order: plain Python functions, and Arrow UDFs over them."""

from __future__ import annotations

import difflib
import hashlib
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from folioforge.functions.latex import brace_end
from folioforge.functions.latex import sanitize as sanitize_latex

#: Ligatures, hyphen-like characters, hyphens that end a line, superscripts and marks of math.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
HYPHENS = "‐‑‒–−"
LINE_HYPHENS = ("-", "‐", "\u00ad")
SUPERSCRIPTS, PLAIN = "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻", "0123456789+-"
MATH_MARKS = frozenset(SUPERSCRIPTS + "₀₁₂₃₄₅₆₇₈₉₊₋×÷")


def normalize_prose(text: str, compare: bool = False) -> str:
    """NFC (NFKC to compare), ligatures spelled out, white space squeezed; to compare, hyphens are one character."""
    text = unicodedata.normalize("NFKC" if compare else "NFC", text)
    for a, b in LIGATURES.items():
        text = text.replace(a, b)
    if compare:
        text = re.sub(f"[{HYPHENS}]", "-", text)
    return re.sub(r"\s+", " ", text).strip()


def rejoin_words(text: str, is_word: Callable[[str], bool]) -> str:
    """Joins two runs of ASCII letters one blank apart if together they are a word and not both are one; a joined run may join
    again. Other characters between them, also none or several blanks, keep them apart."""
    out: list[str] = []
    for part in re.findall("[A-Za-z]+|[^A-Za-z]+", text):
        if len(out) >= 2 and out[-1] == " " and part.isalpha() and is_word(out[-2] + part) and not (is_word(out[-2]) and is_word(part)):
            out[-2:] = [out[-2] + part]
        else:
            out.append(part)
    return "".join(out)


def join_words(words: list[str]) -> str:
    """Words in order as prose: one that ends in a hyphen joins the next without a blank, and without the hyphen where it stands
    between lower-case ASCII letters. NFC, ligatures spelled out."""
    out: list[str] = []
    for word in words:
        if out and len(out[-1]) > 1 and out[-1][-1] in LINE_HYPHENS:
            soft = "a" <= out[-1][-2] <= "z" and "a" <= word[:1] <= "z"
            out[-1] = (out[-1][:-1] if soft else out[-1]) + word
        else:
            out.append(word)
    return normalize_prose(" ".join(out))


#: Fixed value: words before a colon that open a list inside a clause.
_OPENS_LIST = re.compile(r"^(.*?\b(?:comprising|comprises|consisting(?:\s+essentially)?\s+of|including|includes)\s*:)\s*(.+)$", re.I)


def structure_claims(text: str) -> list[tuple[int, str]]:
    """(number, Markdown) of claims 1., 2., ...: each search starts after the last hit and the first gap ends it.

    A number counts where it follows white space and precedes, a stop between, a capital, a bracket or a quote. Clauses
    after a colon become a list where a semicolon parts them; one that itself opens a list is two lines.
    """
    text = " ".join(text.split())
    found, at, n = [], 0, 1
    while hit := re.compile(rf"(?:(?<=\s)|^){n}\.\s*(?=[A-Z(\"])").search(text[at:]):
        found.append((n, at + hit.start(), at + hit.end()))
        at, n = at + hit.end(), n + 1
    ends = [x[1] for x in found[1:]] + [len(text)]
    return [(k, _claim(k, text[b:e].strip())) for (k, _, b), e in zip(found, ends, strict=False)]


def _claim(n: int, body: str) -> str:
    head, colon, rest = body.partition(":")
    if not colon or ";" not in rest:
        return f"{n}. {body}"
    lines = [f"{n}. {head.strip()}:"]
    for clause in filter(None, (x.strip() for x in rest.split(";"))):
        parts = _OPENS_LIST.match(clause)
        lines += [f"   - {x.strip()}" for x in (parts.groups() if parts else (clause,))]
    return "\n".join(lines)


def strip_math(text: str) -> str:
    """Without $...$, \\(...\\) and \\[...\\] (to the end where one is not closed), then without commands and their nested arguments."""
    text = re.sub(r"\$[^$]*(?:\$|\Z)|\\\(.*?(?:\\\)|\Z)|\\\[.*?(?:\\\]|\Z)", "", text, flags=re.S)
    out, i = [], 0
    for hit in re.finditer(r"\\[A-Za-z]+", text):
        if hit.start() < i:
            continue
        out.append(text[i : hit.start()])
        i = hit.end()
        while i < len(text) and text[i] == "{":
            end = brace_end(text, i)
            i = end if end > 0 else len(text)
    return "".join([*out, text[i:]])


def strip_math_tokens(text: str) -> str:
    """Without tokens that hold a mark of math."""
    return " ".join(t for t in text.split() if not MATH_MARKS & set(t))


#: Forms of numbers, in order of precedence, and what may be a unit after one.
_NUMBER = (
    r"(?<![A-Za-z0-9])\d+(?:\.\d+)?\s*[-–−~]\s*\d+(?:\.\d+)?(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])[-+−]?\d+(?:\.\d+)?\s*[×xX]\s*10\^[-+−]?\d+"
    r"|(?<![A-Za-z0-9])[-+−]?\d+(?:\.\d+)?[eE][-+−]?\d+"
    r"|(?<![A-Za-z0-9])[-+−]?\d+(?:\.\d+)?\^[-+−]?\d+"
    r"|(?<![A-Za-z0-9])[-+−]?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?%?"
)
_UNIT = r"[A-Za-zµμΩ°%]{1,8}(?:/[A-Za-zµμΩ°]{1,8})?"
_RAISED = re.compile(r"(?<=[0-9])([⁺⁻]?[⁰¹²³⁴⁵⁶⁷⁸⁹]+)")
_ALONE = re.compile(r"(?<![0-9])([⁺⁻]?[⁰¹²³⁴⁵⁶⁷⁸⁹]+)")
_FOLD = str.maketrans(SUPERSCRIPTS, PLAIN)


def numeric_tokens(text: str, units: bool = True) -> list[str]:
    """Numbers as written, a raised exponent as ^n and a minus sign as a hyphen; each may be followed by its unit, which is a short
    run of letters with a capital, a slash or a sign such as °."""
    marked = _RAISED.sub(lambda m: "^" + m[1].translate(_FOLD), text)
    out = []
    for m in re.finditer(_NUMBER, marked, re.A):
        out.append(m[0].replace("−", "-"))
        unit = re.compile(" ?(" + _UNIT + ")").match(marked, m.end()) if units else None
        if unit and ("/" in unit[1] or any(c.isupper() or c in "°Ω%µμ" for c in unit[1])):
            out.append(unit[1])
    return out


def numeric_values(text: str, title: bool = False) -> list[str]:
    """Numbers only, hyphens folded; in a title a raised digit that follows no digit is that digit."""
    text = unicodedata.normalize("NFC", text)
    for c in HYPHENS:
        text = text.replace(c, "-")
    marked = _RAISED.sub(lambda m: "^" + m[1].translate(_FOLD), text)
    return numeric_tokens(_ALONE.sub(lambda m: m[1].translate(_FOLD), marked) if title else marked, units=False)


#: Rewrites that bring numbers of both sides to one form, in order.
SYMBOLS = {"times": "×", "pm": "±", "leq": "≤", "le": "≤", "geq": "≥", "ge": "≥", "mu": "μ", "sigma": "σ", "lambda": "λ", "pi": "π"}
REWRITES = (
    (r"\$\$|\$|\\\(|\\\)|\\\[|\\\]", ""),
    (r"\\%", "%"),
    (r"\\(" + "|".join(SYMBOLS) + ")(?![A-Za-z])", lambda m: SYMBOLS[m[1]]),
    (r"(10)\s*\^\s*\{\s*([-+−]?\d+)\s*\}", lambda m: f"{m[1]}^{m[2].replace('−', '-').lstrip('+')}"),
    (r"([×xX*]\s*10)\s*([-+−])\s*(\d+)", lambda m: f"{m[1]}^{'' if m[2] == '+' else '-'}{m[3]}"),
    (r"(?<=\d)\s*\{\s*,\s*\}\s*(?=\d)", ","),
    (r"(?<![A-Za-z0-9])(\d+(?:\.\d+)?)\s*[eE]\s*([-+−])\s*(\d+)", lambda m: f"{'' if m[1] == '1' else m[1] + '×'}10^{'' if m[2] == '+' else '-'}{m[3]}"),
    (r"\\[A-Za-z]+", " "),
    (r"[{}]", " "),
    (r"(?<=\d),\s+(?=\d)", ","),
    (r"(?<![A-Za-z0-9])[‒–−](?=\d)", "-"),
    (r"(?<=\d)\s+(?=%)", ""),
    (r"(?<![\d,])([-+−]?\d+),(\d{1,2})(?!\d)", lambda m: f"{m[1].replace('−', '-')}.{m[2]}"),
    (r"(?<=\d)([µμ]T)(?=[A-Za-z]{3,})", r"\1 "),
    (r"^\s*[—–-]\s*\d+(?:[.,]\d+)?%?\s*[—–-]\s*$", ""),
)


def canonical_numbers(text: str) -> str:
    """Ordered numeric rewrites: wrappers, symbols, exponents, decimal commas, signs, percents; a number between dashes is none."""
    for pattern, new in REWRITES:
        text = re.sub(pattern, new, text)
    return text


def last_json_array(text: str) -> list | None:
    """The last balanced top-level JSON array in noisy text."""
    best, decoder, i = None, json.JSONDecoder(), 0
    while (i := text.find("[", i)) >= 0:
        try:
            value, end = decoder.raw_decode(text, i)
        except ValueError:
            i += 1
            continue
        best, i = (value if isinstance(value, list) else best), end
    return best


def math_regions(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, display) of the bodies of $...$ and $$...$$; escaped dollars are none, and an inline one touches no other."""
    at = [m.start() for m in re.finditer(r"\\.|\$", text, re.S) if m[0] == "$"]
    out, k = [], 0
    while k < len(at):
        i = at[k]
        if text[i + 1 : i + 2] == "$":
            end = next((j for j in range(k + 2, len(at)) if text[at[j] + 1 : at[j] + 2] == "$"), None)
            if end is not None:
                out.append((i + 2, at[end], True))
                k = end + 2
                continue
        elif text[i - 1 : i] != "$" or not i:
            j = k + 1
            if j < len(at) and "$" not in (text[at[j] - 1], text[at[j] + 1 : at[j] + 2]):
                out.append((i + 1, at[j], False))
                k = j + 1
                continue
        k += 1
    return out


def tighten(text: str) -> str:
    """Inline math without white space inside its dollars; one that holds nothing else stays."""
    out, at = [], 0
    for a, b, display in math_regions(text):
        out += [text[at:a], text[a:b] if display else text[a:b].strip() or text[a:b]]
        at = b
    return "".join([*out, text[at:]])


#: Fixed value: what follows a dollar that is money.
_MONEY = re.compile(r"\d+(?:[.,]\d+)?(?:\s|$)")


def delimiter_events(text: str) -> list[tuple[str, str, int, int, int, int]]:
    """(kind, severity, start, end, line, column) of inline dollars, line by line: each pair with white space inside, and the last of
    an odd number, which is money if a number follows. Escaped and double dollars play no part."""
    out, base = [], 0
    for n, line in enumerate(text.splitlines(keepends=True), 1):
        at = [m.start() for m in re.finditer(r"\\.|\$\$|\$", line, re.S) if m[0] == "$"]
        for a, b in zip(at[::2], at[1::2], strict=False):
            if line[a + 1 : b] != line[a + 1 : b].strip():
                out.append(("inline_math_delimiter_whitespace", "P1", base + a, base + b + 1, n, a + 1))
        if len(at) % 2:
            money = _MONEY.match(line, at[-1] + 1)
            out.append(("ambiguous_currency_delimiter" if money else "unpaired_math_delimiter", "P2" if money else "P1", base + at[-1], base + at[-1] + 1, n, at[-1] + 1))
        base += len(line)
    return out


def whitespace_proposals(text: str) -> list[tuple[int, int, str]]:
    """Replacements of '$ x $' by '$x$'."""
    return [(a - 1, b + 1, f"${text[a:b].strip()}$") for a, b, display in math_regions(text) if not display and text[a:b] != text[a:b].strip()]


def span_verdicts(text: str, spans: list[tuple]) -> list[str | None]:
    """Verdicts of interval_conflicts() on one text's spans (lo, hi, before, replacement) in order of id, in time that grows with their
    number; none for a span without ends."""
    out: list[str | None] = []
    seen = set()
    for lo, hi, before, new in spans:
        if lo is None or hi is None:
            out.append(None)
        elif not 0 <= lo <= hi <= len(text):
            out.append("target_out_of_range")
        elif before is not None and hashlib.sha256(text[lo:hi].encode()).hexdigest() != before:
            out.append("target_fingerprint_mismatch")
        else:
            out.append("duplicate" if (lo, hi, new) in seen else "kept")
            seen.add((lo, hi, new))
    good = sorted((i for i, v in enumerate(out) if v == "kept"), key=lambda i: spans[i][:2])
    at = Counter(spans[i][0] for i in good if spans[i][0] == spans[i][1])
    last, end = -1, 0
    for i in good:
        lo, hi = spans[i][:2]
        if lo == hi:
            out[i] = "shared_insertion_anchor" if at[lo] > 1 else "kept"
        elif last >= 0 and lo < end:
            out[i] = out[last] = "overlapping_proposals"
            last, end = i, max(end, hi)
        else:
            last, end = i, hi
    return out


def cut_and_join(text: str, patches: list[tuple]) -> str | None:
    """The text with its [lo, hi) replaced, in order of place; null where a replacement is."""
    out, at = [], 0
    for lo, hi, new in patches:
        if new is None:
            return None
        out += [text[at:lo], new]
        at = hi
    return "".join([*out, text[at:]])


def repaired(text: str, spans: list[tuple]) -> dict | None:
    """The text with all of its kept spans replaced, and their number; none if there are none or one of the spans is at fault."""
    told = span_verdicts(text, spans)
    kept = sorted((lo, hi, new) for (lo, hi, _, new), v in zip(spans, told, strict=True) if v == "kept" and new is not None)
    lost = sum(v == "kept" for v in told) - len(kept)
    if not kept or lost or any(v not in (None, "kept", "duplicate") for v in told):
        return None
    return {"text": cut_and_join(text, kept), "n": len(kept)}


#: Fixed value: a denominator that is one primed letter.
_PRIMED = re.compile(r"[a-zA-Z](?:\^\{?\\prime\}?|')$")


def primed_denominators(text: str) -> list[tuple[int, str]]:
    """(position, letter) of fractions whose denominator is one primed letter."""
    out, i = [], 0
    while (i := text.find("\\frac", i)) >= 0:
        a = re.compile(r" *(?=\{)").match(text, i + 5)
        over = brace_end(text, a.end()) if a else -1
        b = re.compile(r" *(?=\{)").match(text, over) if over > 0 else None
        under = brace_end(text, b.end()) if b else -1
        if under > 0:
            if _PRIMED.match(text[b.end() + 1 : under - 1]):
                out.append((i, text[b.end() + 1] + "'"))
            i = under
        else:
            i = over if over > 0 else i + 5
    return out


#: Operators that nearly always carry limits, what may stand between them and the limits, and the one context without.
BARE_OPERATORS = ("\\oint", "\\oiint", "\\oiiint", "\\int", "\\iint", "\\iiint", "\\sum", "\\prod", "\\coprod", "\\lim")
_BARE = re.compile("(" + "|".join(re.escape(x) for x in sorted(BARE_OPERATORS, key=len, reverse=True)) + r")(?![a-zA-Z])(?!\s*(?:\\limits|\\nolimits)?\s*[_^])")
_CURL = ("\\overrightarrow{\\nabla}\\times", "d\\overrightarrow{a}", "d\\overrightarrow{l}")


def formula_suspicions(text: str) -> list[tuple[str, str, int]]:
    """(kind, what, position) in order of position: large operators without limits, but for Stokes' theorem, and fractions over a
    primed letter."""
    out = []
    for m in _BARE.finditer(text):
        left, right = text.rfind("$$", 0, m.start()), text.find("$$", m.end())
        near = text[left + 2 : right] if left >= 0 and right >= 0 else text[max(0, m.start() - 400) : m.end() + 400]
        if not all(x in near for x in _CURL):
            out.append(("bare_op", m[1], m.start()))
    out += [("frac_primed_denom", f"frac÷{letter}", at) for at, letter in primed_denominators(text)]
    return sorted(out, key=lambda x: x[2])


def subtokens(word: str) -> list[str]:
    return re.findall("[a-z0-9]+", word.lower())


def consume_tokens(source: list[tuple[str, bool]], output: str, markers: tuple[str, ...] = ()) -> dict[str, int]:
    """How many source words (word, is noise), in page order, are noise, matched, merged, part of a marker phrase, or unexplained.

    Words take the output's tokens in order, all of a word's tokens or none. One left over is merged if each of its tokens
    still is in the output, or has three characters and is part of a longer output token of four or more. Of those left
    then, the marker phrase with the largest overlap explains its own tokens once.
    """
    have = Counter(subtokens(output))
    long = "\n".join(t for t in have if len(t) >= 4)
    inside: dict[str, bool] = {}
    out = dict.fromkeys(("noise", "matched", "merged", "marker", "unexplained"), 0)
    left: list[list[str]] = []
    for word, noise in source:
        own = subtokens(word)
        if noise:
            out["noise"] += 1
        elif not own:
            continue
        elif all(have[t] > 0 for t in own):
            have.subtract(own)
            out["matched"] += 1
        elif all(have[t] > 0 or (len(t) >= 3 and (inside[t] if t in inside else inside.setdefault(t, t in long))) for t in own):
            out["merged"] += 1
        else:
            left.append(own)
    budget = marker_budget(Counter(t for own in left for t in own), markers)
    for own in left:
        if all(budget[t] > 0 for t in own):
            budget.subtract(own)
            out["marker"] += 1
        else:
            out["unexplained"] += 1
    return out


def marker_budget(left: Counter, markers: tuple[str, ...]) -> Counter:
    """Tokens of the marker whose bag overlaps most with what is left; the first of equals, none without overlap."""
    bags = [Counter(subtokens(m)) for m in markers]
    best = max(bags, key=lambda b: (left & b).total(), default=Counter())
    return Counter(best) if (left & best).total() else Counter()


def diff_runs(a: list[str], b: list[str], most: int = 3, width: int = 80) -> tuple[list[str], list[str]]:
    """Samples of runs that only one side has."""
    gone, new = [], []
    for kind, i, j, k, m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if kind in ("delete", "replace") and len(gone) < most and j > i:
            gone.append(" ".join(a[i:j])[:width])
        if kind in ("insert", "replace") and len(new) < most:
            new.append(" ".join(b[k:m])[:width])
    return gone, new


#: Fixed value: texts of a batch that are Python strings at a time.
SLICE = 64


def text_udf(f: Callable[[str], object], returns: str) -> Callable[[Column], Column]:
    """An Arrow UDF of a function of text; nulls stay null."""
    kind = to_arrow_type(DataType.fromDDL(returns))

    @F.arrow_udf(returns)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [pa.array([None if x is None else f(x) for x in texts.slice(i, SLICE).to_pylist()], kind) for i in range(0, len(texts), SLICE)]
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    return run


def valid_rows(value: list | None, fields: dict[str, type | tuple]) -> list[dict] | None:
    """The array if each of its values is an object with just these fields of these types (no boolean counts as a number), else null."""
    if value is None or any(not isinstance(x, dict) or set(x) != set(fields) for x in value):
        return None
    return value if all(isinstance(x[k], kind) and not (isinstance(x[k], bool) and kind is not bool) for x in value for k, kind in fields.items()) else None


def map_changes(pages: list[str], current: str) -> dict[int, str] | None:
    """Which pages an edited document changed, and their new text: page number -> text. Pages are joined by blank lines. Null if a
    change crosses pages, touches a boundary, or cannot be placed."""
    lines, owner = [], []
    for n, page in enumerate(pages):
        body = page.splitlines(keepends=True)
        lines += body
        owner += [n] * len(body)
        if n + 1 < len(pages):
            lines += ["\n", "\n"] if page.endswith("\n") else []
            owner += [-1, -1] if page.endswith("\n") else []
    new = current.splitlines(keepends=True)
    out: dict[int, list[str]] = {n: [] for n in range(len(pages))}
    changed: set[int] = set()
    for kind, i, j, k, m in difflib.SequenceMatcher(None, lines, new, autojunk=False).get_opcodes():
        if kind == "equal":
            for a in range(i, j):
                if owner[a] >= 0:
                    out[owner[a]].append(lines[a])
            continue
        # An insertion belongs to the page around it, strictly inside; a replacement to the one page of all its lines.
        around = {owner[a] for a in range(i, j)} if j > i else {owner[i - 1] if i else -1, owner[i] if i < len(owner) else -1}
        if len(around) != 1 or -1 in around:
            return None
        n = around.pop()
        changed.add(n)
        out[n] += new[k:m]
    return {n: "".join(out[n]) for n in sorted(changed)}


#: Headings of sections, and a run of capitals before ordinary text.
SECTIONS = ("CROSS-REFERENCE", "FIELD OF THE INVENTION", "FIELD OF THE DISCLOSURE", "FIELD", "BACKGROUND", "SUMMARY", "BRIEF DESCRIPTION OF THE DRAWINGS", "BRIEF DESCRIPTION", "DETAILED DESCRIPTION", "DESCRIPTION")
_INLINE_HEAD = re.compile(r"((?:[A-Z][A-Z0-9&/.\-]*\s+)+)(?=[A-Z][a-z])")


def _capitals(text: str) -> bool:
    return not re.search("[a-z]", text) and any(c.isalpha() for c in text)


def _section(text: str, sections: tuple[str, ...]) -> bool:
    norm = lambda t: " ".join(t.upper().replace("-", " ").split())
    return any(norm(text) == k or norm(text).startswith(k + " ") for k in map(norm, sections))


def mark_headings(text: str, sections: tuple[str, ...] = SECTIONS) -> str:
    """Paragraphs of capitals as headings, neighbours merged, if they name a section or have three words and twelve characters;
    and a section's name in capitals that runs into ordinary text."""
    out: list[str] = []
    block: list[str] = []

    def flush():
        if block:
            head = " ".join(block)
            out.append(f"## {head.title()}" if _section(head, sections) or (len(head.split()) >= 3 and len(head) >= 12) else head)
            block.clear()

    for p in filter(None, (x.strip() for x in text.split("\n\n"))):
        if _capitals(p):
            block.append(p)
            continue
        flush()
        run = _INLINE_HEAD.match(p)
        if run and _section(run[1], sections):
            out.append(f"## {run[1].strip().title()}")
            p = p[run.end() :].strip()
        if p:
            out.append(p)
    flush()
    return "\n\n".join(out)


def strip_title(text: str, title: str = "") -> str:
    """Without leading paragraphs of capitals whose words are all the title's (any, where there is no title)."""
    words = lambda t: set(re.findall("[A-Z]+", t.upper()))
    paras = text.split("\n\n")
    while paras:
        p = paras[0].strip()
        if len(p) <= 3 or not _capitals(p) or (words(title) and words(p) and not words(p) <= words(title)):
            break
        paras.pop(0)
    return "\n\n".join(paras).strip()


def clean_markdown(text: str) -> str:
    """Blanks and blank lines squeezed; this also shortens the indent of claims."""
    return re.sub(r"\n{3,}", "\n\n", re.sub(r" +\n", "\n", re.sub(r"[ \t]+", " ", text))).strip()


def cover_fields(text: str) -> dict:
    """title, inventors, assignee, date, classes, abstract of a cover's (NN) fields; the first field with text counts."""
    parts = re.split(r"\(([0-9]{2})\)", text)
    field: dict[str, str] = {}
    for code, body in zip(parts[1::2], parts[2::2], strict=False):
        if body.strip():
            field.setdefault(code, body.strip())
    tidy = lambda t: " ".join(t.split()).strip(" :;,.")
    names = [x.split(",")[0].strip() for x in re.sub(r"(?i)^\s*Inventors?\s*:?", "", field.get("72") or field.get("75") or "").split(";")]
    owner = re.sub(r"(?i)^\s*(Assignee|Applicant)\s*:?", "", field.get("73") or field.get("71") or "")
    codes = [re.sub(r"\s+", "", c) for c in re.findall(r"[A-H][0-9]{2}[A-Z]\s?[0-9]+/[0-9]+", f"{field.get('51', '')} {field.get('52', '')}")]
    return {
        "title": tidy(field.get("54", "")), "inventors": [n for n in names if len(n) > 1 and not n.lower().startswith(("assignee", "appl"))][:12],
        "assignee": tidy(re.split(r"(?i)\(\s*\*\s*\)|Notice|Subject\s+to", owner)[0].split(";")[0]), "date": iso_date(field.get("45", "")),
        "classes": list(dict.fromkeys(codes)), "abstract": " ".join(re.sub(r"(?i)^\s*ABSTRACT\s*", "", field.get("57", "")).split()),
    }


_MONTHS = {m: i for i, m in enumerate(("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"), 1)}


def iso_date(text: str) -> str:
    m = re.search(r"([A-Z][a-z]{2})[a-z]*\.?\s+([0-9]{1,2}),\s*([0-9]{4})", text)
    return f"{m[3]}-{_MONTHS[m[1].lower()]:02d}-{int(m[2]):02d}" if m and m[1].lower() in _MONTHS else ""


def yaml_header(values: dict) -> str:
    """A front-matter block; lists one entry a line, quotes inside values turned."""
    quote = lambda v: '"' + (v or "").replace('"', "'").strip() + '"'
    lines = ["---"]
    for key, value in values.items():
        if isinstance(value, list):
            lines += [f"{key}:", *(f"  - {quote(x)}" for x in value)] if value else [f"{key}: []"]
        else:
            lines.append(f"{key}: {quote(value)}")
    return "\n".join([*lines, "---"])
