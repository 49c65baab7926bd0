"""Column functions over text: splits, dates, identifiers, image references, numbers, formulas, fingerprints, newlines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Phrases that open the claims, in order of priority.
CLAIMS = ("What is claimed is", "What is claimed", "The invention claimed is", "We claim", "I claim", "It is claimed")
SUPERSCRIPTS, PLAIN = "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻", "0123456789+-"
#: Suffixes of images, and commands that renderers lack.
IMAGES = "png|jpe?g|gif|webp|svg|bmp|tiff?"
INCOMPATIBLE = ("\\displaylimits", "\\boldmath")


def split_claims(text: Column, markers: tuple[str, ...] = CLAIMS) -> Column:
    """struct(before, claims): cut at the earliest marker, which is removed; no marker leaves claims null."""
    low = F.lower(text)
    at = F.array_min(F.filter(F.array(*[F.instr(low, m.lower()) for m in markers]), lambda i: i > 0))
    rest = F.substring(text, at, F.length(text))
    strip = F.regexp_replace(rest, "(?i)^(?:" + "|".join(markers) + r")\s*:?\s*", "")
    return F.struct(F.when(at.isNull(), text).otherwise(F.substring(text, F.lit(1), at - 1)).alias("before"), F.when(at.isNotNull(), strip).alias("claims"))


def iso_date(text: Column) -> Column:
    """'Mon. D, YYYY' as YYYY-MM-DD, else empty."""
    part = lambda i: F.regexp_extract(text, r"([A-Z][a-z]{2})[a-z]*\.?\s+([0-9]{1,2}),\s*([0-9]{4})", i)
    day = F.try_to_date(F.concat_ws(" ", part(1), part(2), part(3)), "MMM d yyyy")
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(""))


def inid_fields(text: Column) -> Column:
    """Map of (NN) fields to their text; the first that is not empty wins."""
    parts = F.slice(F.split(F.regexp_replace(text, r"\(\s*([0-9]{2})\s*\)", "\u0001$1\u0002"), "\u0001"), 2, 1000000)
    pairs = F.filter(F.transform(parts, lambda p: F.struct(F.element_at(F.split(p, "\u0002"), 1).alias("k"), F.trim(F.element_at(F.split(p, "\u0002"), 2)).alias("v"))), lambda s: s["v"] != "")
    first = F.filter(pairs, lambda s, i: ~F.exists(F.slice(pairs, F.lit(1), i), lambda t: t["k"] == s["k"]))
    return F.map_from_entries(first)


def squeeze(text: Column) -> Column:
    """Trailing blanks, runs of blanks and runs of blank lines reduced."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"[ \t]+\n", "\n"), r"[ \t]{2,}", " "), r"\n{3,}", "\n\n"))


def image_refs(md: Column) -> Column:
    """Targets of Markdown and HTML images."""
    return F.concat(F.regexp_extract_all(md, F.lit(r"!\[[^\]]*\]\(([^)\s]+)[^)]*\)"), F.lit(1)), F.regexp_extract_all(md, F.lit(r"""<img[^>]*\ssrc=["']([^"']+)["']"""), F.lit(1)))


def is_local(ref: Column) -> Column:
    """An image file that is not elsewhere: no scheme, and a known suffix before any query or fragment."""
    return ~ref.rlike(r"^\s*(?i)(https?:|data:|//|mailto:)") & F.regexp_replace(ref, "[?#].*$", "").rlike(rf"(?i)\.({IMAGES})\s*$")


def rewrite_refs(md: Column, assets: str) -> Column:
    """Local image targets, in Markdown and HTML, moved to an assets folder under their file name."""
    local = rf"(?!\s*(?:https?:|data:|//|mailto:))(?:[^)\s\"']*/)?([^)/\s\"'?#]+\.(?:{IMAGES}))(?:[?#][^)\s\"']*)?"
    md = F.regexp_replace(md, rf"(?i)(!\[[^\]]*\]\()\s*{local}(\s[^)]*)?\)", f"$1{assets}/$2$3)")
    return F.regexp_replace(md, rf"""(?i)(<img\b[^>]*?\bsrc\s*=\s*["']){local}(["'])""", f"$1{assets}/$2$3")


def incompatible_commands(md: Column) -> Column:
    return F.filter(F.array(*map(F.lit, INCOMPATIBLE)), lambda c: F.contains(md, c))


def number_from_name(stem: Column) -> Column:
    """The document number in a file's name, without a leading zero, else the name."""
    part = lambda i: F.upper(F.regexp_extract(stem, r"(?i)(US|EP|WO|CN|JP)\s*0?([0-9]+)\s*([A-Z]\d?)", i))
    return F.when(part(1) != "", F.concat(part(1), part(2), part(3))).otherwise(stem)


def topic_of_name(stem: Column) -> Column:
    """The topic tag in a file's name (_T1a_..., _X_...), its parts joined; else empty."""
    part = lambda i: F.nullif(F.regexp_extract(stem, r"_(T\d[A-Za-z]*|X[A-Za-z]*)_?(.*)$", i), F.lit(""))
    return F.concat_ws("_", part(1), part(2))


def country_of(number: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(number, "^([A-Z]{2})", 1), F.lit("")), F.lit("?"))


#: Forms of numbers, in order of precedence, and what may be a unit after one.
NUMBER = (
    r"(?<![A-Za-z0-9])\d+(?:\.\d+)?\s*[-–−~]\s*\d+(?:\.\d+)?(?![A-Za-z0-9])|(?<![A-Za-z0-9])[-+−]?\d+(?:\.\d+)?\s*[×xX]\s*10\^[-+−]?\d+"
    r"|(?<![A-Za-z0-9])[-+−]?\d+(?:\.\d+)?[eE][-+−]?\d+|(?<![A-Za-z0-9])[-+−]?\d+(?:\.\d+)?\^[-+−]?\d+"
    r"|(?<![A-Za-z0-9])[-+−]?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?%?"
)
UNIT = r"[A-Za-zµμΩ°%]{1,8}(?:/[A-Za-zµμΩ°]{1,8})?"


def numeric_tokens(text: Column) -> Column:
    """Numbers as written, each followed by its unit if it has one; a raised exponent becomes ^n, a minus sign a hyphen."""
    marked = F.regexp_replace(text, f"(?<=[0-9])([⁺⁻]?[{SUPERSCRIPTS[:10]}]+)", "\u0001$1\u0002")
    marked = F.array_join(F.transform(F.split(marked, "\u0001"), lambda x: F.when(F.contains(x, F.lit("\u0002")), F.concat(F.lit("^"), F.translate(F.substring_index(x, "\u0002", 1), SUPERSCRIPTS, PLAIN), F.substring_index(x, "\u0002", -1))).otherwise(x)), "")
    both = lambda i: F.regexp_extract_all(marked, F.lit(rf"({NUMBER})(?= ?({UNIT})?)"), F.lit(i))
    pairs = F.arrays_zip(both(1).alias("n"), both(2).alias("u"))
    unit = lambda u: F.when(u.rlike(r"[/\p{Lu}°Ω%µμ]"), u)
    return F.array_compact(F.flatten(F.transform(pairs, lambda x: F.array(F.translate(x["n"], "−", "-"), unit(x["u"])))))


def odd_dollars(line: Column) -> Column:
    """Whether a line has an odd number of single, unescaped dollars."""
    return F.regexp_count(line, F.lit(r"(?<!\\)(?<!\$)\$(?!\$)")) % 2 == 1


def tight_math(line: Column) -> Column:
    """'$ x $' as '$x$'."""
    return F.regexp_replace(line, r"(?<!\\)(?<!\$)\$(?!\$)[ \t]*([^$\n]*?)[ \t]*(?<!\\)\$(?!\$)", r"\$$1\$")


def normal_latex(text: Column) -> Column:
    """Without outer math marks and white space."""
    return F.regexp_replace(F.regexp_replace(F.trim(text), r"^(?:\$\$|\$|\\\[|\\\()\s*|\s*(?:\$\$|\$|\\\]|\\\))$", ""), r"\s+", "")


def code_fence(content: Column) -> Column:
    """A fence longer than any run of backticks inside."""
    longest = F.coalesce(F.array_max(F.transform(F.regexp_extract_all(content, F.lit("`+"), F.lit(0)), lambda x: F.length(x))), F.lit(0))
    fence = F.repeat(F.lit("`"), F.greatest(longest + 1, F.lit(3)))
    return F.concat(fence, F.lit("\n"), content, F.lit("\n"), fence)


def formula_body(content: Column) -> Column:
    """Without the outer $$ of a displayed formula; at its end a longer run of dollars is text, so it closes none."""
    t = F.trim(content)
    return F.when(t.rlike(r"(?s)^\$\$(?:.*[^$])?\$\$\z"), F.trim(F.regexp_replace(t, r"(?s)^\$\$|\$\$$", ""))).otherwise(t)


def strip_tags(latex: Column) -> Column:
    """Without \\tag{...}."""
    return F.trim(F.regexp_replace(latex, r"\\tag\*?\{[^{}]*\}", ""))


def hard_breaks(content: Column) -> Column:
    """Line ends that Markdown keeps."""
    return F.replace(content, F.lit("\n"), F.lit("  \n"))


def newline_style(text: Column) -> Column:
    """LF or CRLF; mixed or lone CR is null."""
    crlf, lf, cr = F.regexp_count(text, F.lit("\r\n")), F.regexp_count(text, F.lit("(?<!\r)\n")), F.regexp_count(text, F.lit("\r(?!\n)"))
    return F.when((cr > 0) | ((crlf > 0) & (lf > 0)), F.lit(None).cast("string")).when(crlf > 0, "CRLF").otherwise("LF")
