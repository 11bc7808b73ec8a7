"""Bounded exact-key matching, two modes, without a model.

``simple``: keys country + first two words, country + first word + street number, and, for sources that
have found nothing so, country + only word. ``strict``: keys compact name, first word + number, first
two words, verified by conflicts and rules. A key's posting list holds the first ``posting`` targets
in file order, which is this matcher's definition of a match, not a guard against skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T

# Words that do not tell companies apart.
COMMON_WORDS = (
    "inc", "corp", "corporation", "llc", "ltd", "limited", "pvt", "private", "sarl", "sa", "sas", "gmbh", "co", "company", "services", "solutions", "enterprises", "trading", "technologies", "group",
    "the", "and", "de", "la", "du", "des", "les", "en", "null", "none", "of", "in", "for", "at",
)
# The codes of the states of the USA, and of DC.
US_STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC",
    "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC",
)
# Names of Indian states without blanks.
INDIAN_STATES = (
    "maharashtra", "delhi", "karnataka", "tamilnadu", "uttarpradesh", "gujarat", "westbengal", "rajasthan", "telangana", "andhrapradesh", "kerala", "madhyapradesh", "punjab", "haryana", "bihar", "odisha",
    "orissa", "assam", "jharkhand", "chhattisgarh", "uttarakhand", "goa", "himachalpradesh", "chandigarh", "puducherry", "jammuandkashmir",
)
# Fixed pattern: web and courtesy parts of names.
NOISE = r"(@|www\.|\.com|\.in|\.fr|\.org|\.net|\bthe\b|\bmr\b|\bmrs\b|\bms\b)"


def tokens(name: Column, least: int) -> Column:
    found = F.regexp_extract_all(F.lower(name), F.lit("[a-z0-9]+"), F.lit(0))
    return F.filter(found, lambda w: (F.length(w) >= least) & ~w.isin(*COMMON_WORDS))


def plain(name: Column) -> Column:
    """Lower case without web and courtesy parts, in ASCII: letters lose their marks, other ones go."""
    return F.regexp_replace(F.lower(T.ascii_letters(name)), NOISE, " ")


def number(address: Column, strip: bool) -> Column:
    n = F.regexp_extract(address, r"(?U)\b\d+\b", 0)
    return F.when(n.rlike("^0+$"), "0").otherwise(F.regexp_replace(n, "^0+", "")) if strip else n


def state(address: Column, country: Column) -> Column:
    codes = F.filter(F.regexp_extract_all(F.upper(address), F.lit(r"\b[A-Z]{2}\b"), F.lit(0)), lambda c: c.isin(*US_STATES))
    squeezed = F.regexp_replace(F.lower(address), "[ .,]", "")
    india = F.coalesce(*[F.when(F.contains(squeezed, F.lit(s)), s) for s in sorted(INDIAN_STATES, key=lambda s: (-len(s), s))], F.lit(""))
    france = F.regexp_extract(F.upper(address), r"\b(0[1-9]|[1-8][0-9]|9[0-8]|2A|2B)\b", 1)
    return F.when(country == "us", F.coalesce(F.try_element_at(codes, F.lit(-1)), F.lit(""))).when(country == "india", india).when(country == "france", france).otherwise("")


def grams(a: Column, b: Column) -> Column:
    """Jaccard of unpadded 3-grams; shorter texts must be equal."""
    cut = lambda x: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - 2, F.lit(1))), lambda i: F.substring(x, i, F.lit(3))))
    return F.when((a == "") | (b == ""), 0.0).when((F.length(a) < 3) | (F.length(b) < 3), (a == b).cast("double")).otherwise(S.jaccard(cut(a), cut(b)))


def described(records: DataFrame, mode: str) -> DataFrame:
    """id, pos (place in file), country, tokens, num, and for ``strict`` compact and state."""
    c = F.lower(F.trim("country"))
    if mode == "simple":
        return records.select("id", "pos", c.alias("country"), tokens(F.col("business_name"), 3).alias("tokens"), number(F.col("business_address"), False).alias("num"))
    t = tokens(plain(F.col("business_name")), 2)
    return records.select("id", "pos", c.alias("country"), t.alias("tokens"), F.array_join(t, "").alias("compact"), number(F.col("business_address"), True).alias("num"), state(F.col("business_address"), c).alias("state"))


def _keys(records: DataFrame, mode: str) -> DataFrame:
    """Rows (…, prio, key): a record's keys, prio in probing order."""
    k = lambda name, *parts: F.concat_ws("#", "country", F.lit(name), *parts)
    first, second, n = F.get("tokens", F.lit(0)), F.get("tokens", F.lit(1)), F.size("tokens")
    numbered = F.when((n > 0) & (F.col("num") != ""), k("ns", first, "num"))
    two = F.when(n >= 2, k("n2", first, second))
    keys = [numbered, two, F.when(n == 1, k("n1", first))] if mode == "simple" else [F.when(F.col("compact") != "", k("ex", "compact")), numbered, two]
    out = records.select("*", F.posexplode(F.array(*keys)).alias("prio", "key"))
    return out.where("key is not null")


def match(s1: DataFrame, targets: dict[str, DataFrame], mode: str = "simple", posting: int = 4) -> DataFrame:
    """source1_id, target_source, target_id, rank, matched: candidates of each source-1 record by source, at
    most 4 (``strict``: 5) in probing order. Frames: id, pos, business_name, business_address, country."""
    cap = 4 if mode == "simple" else 5
    left = _keys(described(s1, mode), mode)
    found = None
    for source, target in sorted(targets.items()):
        right = _keys(described(target, mode), mode)
        w = Window.partitionBy("key").orderBy("pos")
        extra = ["tokens", "compact", "num", "state"] if mode == "strict" else []
        listed = right.withColumn("place", F.row_number().over(w)).where(F.col("place") <= posting).select("key", "place", F.col("id").alias("target_id"), *[F.col(c).alias(f"t_{c}") for c in extra])
        hits = left.withColumnRenamed("id", "source1_id").join(listed, "key").withColumn("target_source", F.lit(source))
        found = hits if found is None else found.unionByName(hits)
    if mode == "simple":  # a lone word counts only where no better key has hit in any source
        high = found.where("prio < 2").select("source1_id").distinct()
        found = found.where("prio < 2").unionByName(found.where("prio = 2").join(high, "source1_id", "left_anti"))
    once = Window.partitionBy("source1_id", "target_source", "target_id").orderBy("prio", "place")
    found = found.withColumn("_o", F.row_number().over(once)).where("_o = 1")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("source1_id", "target_source").orderBy("prio", "place"))).where(F.col("rank") <= cap)
    matched = F.col("rank") <= 2 if mode == "simple" else _verified()
    return ranked.select("source1_id", "target_source", "target_id", F.col("rank").cast("long").alias("rank"), matched.alias("matched"))


def _verified() -> Column:
    c = F.col
    states = (c("state") == "") | (c("t_state") == "") | (c("state") == c("t_state"))
    numbers = (c("num") == "") | (c("t_num") == "") | c("num").startswith(c("t_num")) | c("t_num").startswith(c("num"))
    head = F.slice("t_tokens", 1, 3)
    near = grams(c("compact"), c("t_compact"))
    same_number = (c("num") != "") & (c("num") == c("t_num")) & states & (F.size("tokens") > 0) & (F.size(head) > 0) & ((F.get("tokens", F.lit(0)) == F.get(head, F.lit(0))) | (near >= 0.50))
    long_ = (F.length("compact") >= 5) & (F.length("t_compact") >= 5) & (near >= 0.75)
    rules = ((c("compact") != "") & (c("compact") == c("t_compact"))) | F.coalesce(same_number, F.lit(False)) | (S.jaccard("tokens", head) >= 0.60) | long_
    return states & numbers & rules
