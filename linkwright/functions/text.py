"""Names and addresses as column expressions: normal form, legal forms, address parts, phonetic code.

Everything here stays in the JVM except ``normalize`` for non-ASCII rows, for which Spark has no
Unicode decomposition: those rows, and only those, pass through one Arrow UDF.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Endings of company names and the form each stands for.
LEGAL_FORMS = {
    "private limited": "private limited",
    "private ltd": "private limited",
    "pvt ltd": "private limited",
    "pvt limited": "private limited",
    "limited liability company": "limited liability company",
    "limited liability corp": "limited liability company",
    "p l l c": "professional limited liability company",
    "s a r l": "sarl",
    "s a s": "sas",
    "g m b h": "gmbh",
    "s p a": "spa",
    "s a": "sa",
    "l l c": "llc",
    "l l p": "llp",
    "p l c": "plc",
    "incorporated": "inc",
    "corporation": "corp",
    "company": "co",
    "co": "co",
    "limited": "ltd",
    "private": "private",
    "pvt": "pvt",
    "ltd": "ltd",
    "inc": "inc",
    "corp": "corp",
    "llc": "llc",
    "llp": "llp",
    "plc": "plc",
    "gmbh": "gmbh",
    "sarl": "sarl",
    "sas": "sas",
    "spa": "spa",
    "sa": "sa",
}
# Fixed patterns, with Unicode classes as in the data's own notation.
POSTAL = r"(?U)\b(?:2[ABab]\d{3}|\d{5}(?:-\d{4})?|\d{6}|\d{4,10}|[A-Za-z]{1,2}\d[A-Za-z0-9]?[ -]?\d[A-Za-z]{2}|[A-Z]\d[A-Z][ -]?\d[A-Z]\d|\d{2,4}[A-Z][A-Z0-9]{1,4})\b"
STREET_NUMBER = r"(?U)^\d+[A-Za-z]?$"
CEDEX = r"(?iU)\bcedex(?:\s*\d+)?\b"
PO_BOX = r"(?iU)\bbp\s*\d+\b"
LANDMARK = r"(?iU)\b(near(?:\s+to)?|opp(?:\.|\s+to|\s+site)?|opposite|behind|beside|adj(?:\.|\s+to)?|adjacent(?:\s+to)?|in\s+front\s+of)\b"

#: One alternative for each ending, longest first, so that a lazy prefix leaves the longest ending.
ENDINGS = "|".join(sorted(LEGAL_FORMS, key=lambda s: (-s.count(" "), -len(s), s)))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normal_form(text: str) -> str:
    """The rule in plain Python: decompose, drop marks, fold case, spell out "&", drop apostrophes, and
    turn all that is not a letter or digit into single spaces."""
    kept = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()
    kept = kept.replace("&", " and ")
    return " ".join("".join(c if c.isalnum() else " " for c in kept if c not in "'’‘").split())


def _forms(texts: pd.Series) -> pd.Series:
    return texts.map(normal_form, na_action="ignore")


def _unicode_form(c: Column) -> Column:
    return F.pandas_udf(_forms, "string")(c)


def _decomposed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode(), na_action="ignore")


def ascii_letters(c) -> Column:
    """A column with letters decomposed and what is not ASCII then left out. Only texts that are not
    ASCII reach the Arrow UDF with a value."""
    plain = F.coalesce(_col(c), F.lit("")).rlike(r"^[\x00-\x7F]*$")
    return F.when(plain, _col(c)).otherwise(F.pandas_udf(_decomposed, "string")(F.when(~plain, _col(c))))


def ascii_form(c) -> Column:
    """``normal_form`` for ASCII text, with built-in functions only."""
    t = F.replace(F.lower(F.coalesce(_col(c), F.lit(""))), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(F.replace(t, F.lit("'"), F.lit("")), r"[^a-z0-9]+", " "))


def normalize(c, ascii_only: bool = False) -> Column:
    """``normal_form`` of a column; null is blank. ``ascii_only`` promises plain ASCII and plans no UDF."""
    if ascii_only:
        return ascii_form(c)
    plain = F.coalesce(_col(c), F.lit("")).rlike(r"^[\x00-\x7F]*$")
    return F.coalesce(_unicode_form(F.when(~plain, _col(c))), ascii_form(c))


def words(c) -> Column:
    """Words of a normalised text; a blank has none."""
    return F.when(_col(c) == "", F.array().cast("array<string>")).otherwise(F.split(_col(c), " "))


def strip_legal(normalized) -> Column:
    """struct(brand, legal_form) of a normalised name: endings go one by one from the right, the
    longest that fits first, until none fits."""
    form = F.create_map(*[F.lit(x) for pair in LEGAL_FORMS.items() for x in pair])
    pattern = rf"^(.*?) ({ENDINGS})$"
    start = F.struct(F.concat(F.lit(" "), _col(normalized)).alias("rest"), F.lit("").alias("forms"))

    def step(a, _):
        ending = F.regexp_extract(a["rest"], pattern, 2)
        return F.when(ending == "", a).otherwise(
            F.struct(F.regexp_extract(a["rest"], pattern, 1).alias("rest"), F.trim(F.concat(form[ending], F.lit(" "), a["forms"])).alias("forms"))
        )

    turns = F.sequence(F.lit(1), F.size(F.split(_col(normalized), " ")))
    return F.aggregate(turns, start, step, lambda a: F.struct(F.trim(a["rest"]).alias("brand"), a["forms"].alias("legal_form")))


def routing(address) -> Column:
    """struct(cleaned, routing, numbers): CEDEX and BP parts of an address, then the address without."""
    a = F.coalesce(_col(address), F.lit(""))
    hits = F.concat(F.regexp_extract_all(a, F.lit(CEDEX), F.lit(0)), F.regexp_extract_all(a, F.lit(PO_BOX), F.lit(0)))
    raw = F.flatten(F.transform(hits, lambda h: F.regexp_extract_all(h, F.lit(r"(?U)\d+"), F.lit(0))))
    short = F.transform(raw, lambda n: F.when(n.rlike("^0+$"), F.lit("0")).otherwise(F.regexp_replace(n, "^0+", "")))
    cleaned = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(a, CEDEX, " "), PO_BOX, " "), r"(?U)\s+", " "))
    return F.struct(cleaned.alias("cleaned"), F.array_join(F.transform(hits, lambda h: F.trim(h)), " ").alias("routing"), F.array_union(raw, short).alias("numbers"))


def landmarks(address) -> Column:
    """struct(core, landmark): each clause is cut at its first landmark word."""
    clauses = F.filter(F.transform(F.split(_col(address), "[,;]+"), lambda x: F.trim(x)), lambda x: x != "")
    cuts = F.transform(clauses, lambda x: F.struct(x.alias("x"), F.length(F.element_at(F.split(x, LANDMARK, 2), 1)).alias("at"), x.rlike(LANDMARK).alias("hit")))
    core = F.transform(cuts, lambda c: F.when(c["hit"], F.trim(F.substring(c["x"], F.lit(1), c["at"]))).otherwise(c["x"]))
    mark = F.transform(F.filter(cuts, lambda c: c["hit"]), lambda c: F.trim(F.substring(c["x"], c["at"] + 1, F.length(c["x"]))))
    return F.struct(F.array_join(F.filter(core, lambda x: x != ""), ", ").alias("core"), F.array_join(mark, ", ").alias("landmark"))


def postal_prefix(postal, country) -> Column:
    """The part of a postal code that names an area."""
    p, c = _col(postal), _col(country)
    two = c.isin("france", "fr") | ((c == "") & (F.length(p) == 5) & p.rlike("^[0-9]{2}"))
    return F.when(p == "", "").when(two, F.substring(p, 1, 2)).otherwise(F.substring(p, 1, 3))


def soundex(token) -> Column:
    """American Soundex in which every uncoded letter, H and W too, parts equal codes."""
    t = F.upper(_col(token))
    codes = F.regexp_replace(F.translate(F.regexp_replace(t, "[0-9]", "0"), "BFPVCGJKQSXZDTLMNR", "111122222222334556"), "[^1-6]", "0")
    for d in "123456":
        codes = F.regexp_replace(codes, d + "+", d)
    rest = F.replace(F.substring(codes, F.lit(2), F.length(codes)), F.lit("0"), F.lit(""))
    return F.when(t.rlike(r"^\p{L}"), F.rpad(F.concat(F.substring(t, 1, 1), rest), 4, "0")).otherwise("")


def padded(c, fold: bool = True) -> Column:
    """The text between two spaces on either side, of which n-grams are taken; null for a blank."""
    t = _col(c)
    if fold:
        t = F.trim(F.regexp_replace(F.lower(t), r"\s+", " "))
    return F.when(F.trim(_col(c)) != "", F.concat(F.lit("  "), t, F.lit("  ")))


def shingles(c, size: int = 3, fold: bool = True) -> Column:
    """Distinct character n-grams of the text between two spaces on either side; a blank has none."""
    t = _col(c)
    if fold:
        t = F.trim(F.regexp_replace(F.lower(t), r"\s+", " "))
    t = F.concat(F.lit("  "), t, F.lit("  "))
    grams = F.transform(F.sequence(F.lit(1), F.length(t) - size + 1), lambda i: F.substring(t, i, F.lit(size)))
    return F.when(F.trim(_col(c)) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(grams))
