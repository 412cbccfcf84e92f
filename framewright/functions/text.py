"""Text scalars as Column expressions; no Python runs in them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: words and patterns that decide the results
STOP = "a an the of in on at to for with and or its his her their this that these those".split()
ABSTRACT_HEADS = """shot shots view views angle angles perspective composition lighting illumination
atmosphere ambiance ambience mood texture textures contrast focus depth exposure saturation tone tones
palette aesthetic style styles framing orientation vantage viewpoint""".split()
SHOT_PHRASES = ["close up", "closeup", "wide angle", "eye level", "high angle", "low angle", "birds eye", "overhead", "medium"]
VAGUE = r"(?iuU)^(the|this|a|an)?\s*(entire|whole|overall)?\s*(image|photo|photograph|picture|scene|view|frame|composition|background|foreground)s?$"
NOUN_STOP = """a an the of in on at to for with and or is are was were be been being this that these those
his her its their my your our it he she they them him us we you i as by from into over under near
image photo picture shows showing view background foreground left right center middle top bottom front back
there here which who whom whose what while during also very more most some any all both each other another
one two three several many few little large small big""".split()


def strip(s: Column) -> Column:
    """Without white space at both ends, of any kind that Unicode knows."""
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def norm_phrase(s: Column) -> Column:
    """Lower case; all but a-z, 0-9 as single spaces; trimmed."""
    return F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))


def content_words(norm: Column) -> Column:
    """Words of a normalised text that are no stop words, repeats included."""
    return F.filter(F.split(norm, " "), lambda w: (w != "") & ~w.isin(*STOP))


def word_count(s: Column) -> Column:
    """Words of a raw text, split at white space."""
    return F.size(F.filter(F.split(s, r"(?U)\s+"), lambda w: w != ""))


def is_vague(stripped: Column) -> Column:
    return stripped.rlike(VAGUE)


def is_abstract(norm: Column, cw: Column) -> Column:
    """The last content word names a property of images, or the whole phrase a kind of shot."""
    return (F.size(cw) > 0) & (F.try_element_at(cw, F.lit(-1)).isin(*ABSTRACT_HEADS) | norm.isin(*SHOT_PHRASES))


def padded(s: Column) -> Column:
    """With a space at both ends: whole words of one normalised text are a part of another so padded."""
    return F.concat(F.lit(" "), s, F.lit(" "))


def in_caption(norm: Column, caption: Column, whole_words: bool) -> Column:
    return padded(caption).contains(padded(norm)) if whole_words else caption.contains(norm)


def after_thinking(s: Column) -> Column:
    """What follows the first </think>, stripped; the stripped text if there is none."""
    at = F.locate("</think>", s)
    return strip(F.when(at > 0, F.substring(s, at + F.lit(len("</think>")), F.length(s))).otherwise(s))


def until_end_mark(s: Column) -> Column:
    """Up to the first </s> at or after character 5 (from 0), the mark included."""
    at = F.locate("</s>", s, 6)
    return F.when(at > 0, F.substring(s, F.lit(1), at + 3)).otherwise(s)


def html_escaped(s: Column) -> Column:
    """For text and attributes of HTML."""
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        s = F.replace(s, F.lit(mark), F.lit(name))
    return s


def parse_verdict(answer: Column) -> Column:
    low = F.lower(answer)
    return F.when(low.startswith("yes"), "YES").when(low.startswith("no"), "NO").otherwise("UNPARSED")


def nouns(s: Column) -> Column:
    """Distinct words of three or more letters, hyphens or apostrophes that say something."""
    found = F.regexp_extract_all(F.lower(F.coalesce(s, F.lit(""))), F.lit(r"[a-z][a-z\-']+"), F.lit(0))
    return F.array_distinct(F.filter(found, lambda w: (F.length(w) > 2) & ~w.isin(*NOUN_STOP)))


def prompt(template: str, phrase: Column) -> Column:
    """``template`` with {p} replaced by the stripped phrase."""
    before, _, after = template.partition("{p}")
    return F.concat(F.lit(before), strip(phrase), F.lit(after))


def file_stem(path: Column) -> Column:
    """The file's name up to the first dot."""
    return F.substring_index(F.substring_index(path, "/", -1), ".", 1)


def file_number(path: Column) -> Column:
    return F.nullif(F.regexp_extract(F.substring_index(path, "/", -1), r"(\d+)", 1), F.lit("")).cast("int")


def boxes_by_label(labels: Column, boxes: Column) -> Column:
    """Parallel lists -> one entry for each label that isn't blank, in order of first
    appearance, with its boxes rounded to one decimal in order."""
    pairs = F.filter(F.transform(F.arrays_zip(labels.alias("l"), boxes.alias("b")), lambda z: F.struct(strip(z["l"]).alias("l"), F.transform(z["b"], lambda v: F.round(v, 1)).alias("b"))), lambda z: z["l"] != "")
    names = F.array_distinct(F.transform(pairs, lambda z: z["l"]))
    return F.transform(names, lambda n: F.struct(n.alias("phrase"), F.transform(F.filter(pairs, lambda z: z["l"] == n), lambda z: z["b"]).alias("boxes")))
