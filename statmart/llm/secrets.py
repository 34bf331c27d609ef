"""Secret scans that link the parts of a credential.

Some shapes are secrets by themselves: an assignment to a secret's name, an access identifier, a
long run of hexadecimal digits. Others (a login name, a mixed run of letters and digits, an address
of a service) are weak: they are reported only where complementary parts stand near them in the same
scope. Scopes are the blocks of a text between blank lines. All parts become rows; weak ones meet
the others of their scope in an interval join on buckets of ``reach`` code points, whose size the
least length of a part bounds. DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import free_name, stored


def _any_case(words: str) -> str:
    """A pattern for ``words`` with its letters in either case, the same in every regular expression language."""
    out, escaped = "", False
    for c in words:
        out += f"[{c.upper()}{c}]" if c.isalpha() and not escaped else c
        escaped = c == "\\"
    return out


_IS = r"""["']?\x20*[:=]\x20*["']?"""
#: Kind, pattern, role and whether it is weak, in the order in which spans at the same place are listed.
KINDS = [
    ("assign", f"({_any_case('password|passwd|secret|token|api_?key')}){_IS}([A-Za-z0-9+/_.=-]+)", "secret", False),
    ("access", "AKIA[A-Z0-9]{16,}", "identifier", False),
    ("hex", "[0-9a-f]{24,}", "secret", False),
    ("login", f"(?:{_any_case('username|user_?id|user|login|client_?id|account')}){_IS}[A-Za-z0-9@+/_.-]+", "identifier", True),
    ("key", "[A-Za-z0-9+/_=-]{20,}", "secret", True),
    ("endpoint", f"(?:{_any_case('https?|ftps?|postgresql|postgres|mysql|mongodb|redis|amqps?')})://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+"
                 f"|(?:{_any_case('hostname|host|server|endpoint')}){_IS}[A-Za-z0-9._:/-]+", "endpoint", True),
]
#: What has to stand near a weak part of each role.
COMPLEMENTS = {"secret": ["identifier"], "identifier": ["secret"], "endpoint": ["identifier", "secret"]}
#: What separates scopes.
BREAK = r"\n[ \t\r\n]*\n"
#: An assignment's value has so many characters at least.
VALUE = 6
#: Parts that lie further apart do not belong together.
REACH = 400
BASE = [k for k, _, _, weak in KINDS if not weak]


def _found(text: Column, kind: str, pattern: str) -> Column:
    """For each match in order: the characters between it and the one before it, its own, and whether it counts."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # Both functions walk the text in the same way, so the n-th piece ends where the n-th match begins.
    pieces = F.split(text, pattern, -1)
    if kind == "assign":
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
        counts = F.transform(values, lambda v: F.length(v) >= VALUE)
    elif kind == "key":
        counts = F.transform(matches, lambda m: m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]"))
    else:
        counts = F.transform(matches, lambda m: F.lit(True))
    row = lambda m, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("nr"), F.length(F.get(pieces, i)).alias("gap"), F.length(m).alias("own"), F.get(counts, i).alias("counts")
    )
    none = F.array().cast("array<struct<kind:string,nr:int,gap:int,own:int,counts:boolean>>")
    return F.when(text.rlike(pattern), F.transform(matches, row)).otherwise(none)


def _parts(found: DataFrame, row: str) -> DataFrame:
    """(row, kind, start, end, role, weak, scope) of all parts of all texts."""
    matches = found.filter(F.size("parts") > 0).select(row, F.inline("parts"))
    before = Window.partitionBy(row, "kind").orderBy("nr").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("own")).over(before).cast("int")
    spans = matches.select(row, "kind", "counts", "own", end.alias("end")).filter("counts")
    spans = spans.select(row, "kind", (F.col("end") - F.col("own")).alias("start"), "end")
    # Breaks come first at their place; no match holds one, as none reaches over a line.
    passed = Window.partitionBy(row).orderBy("start", "end").rangeBetween(Window.unboundedPreceding, 0)
    spans = spans.withColumn("scope", F.sum((F.col("kind") == "break").cast("int")).over(passed)).filter("kind <> 'break'")
    of = lambda i: F.create_map(*[F.lit(x) for k in KINDS for x in (k[0], k[i])])[F.col("kind")]
    return spans.withColumns({"role": of(2), "weak": of(3)})


def _linked(parts: DataFrame, row: str, reach: int) -> DataFrame:
    """The weak parts whose complements stand near, with the nearest one of each role (``partners``)."""
    buckets = lambda low, high: F.explode(F.sequence(F.floor(low / reach), F.floor(high / reach)))
    weak = parts.filter("weak").select(
        row, "scope", "role", "kind", "start", "end", buckets(F.col("start") - reach, F.col("end") + reach).alias("bucket")
    )
    other = parts.select(
        row, "scope", F.col("role").alias("o_role"), F.col("weak").alias("o_weak"), F.col("start").alias("o_start"), F.col("end").alias("o_end"),
        F.struct("kind", "start", "end").alias("o"), buckets(F.col("start"), F.col("end")).alias("bucket"),
    )
    gap = F.greatest(F.col("o_start") - F.col("end"), F.col("start") - F.col("o_end"))
    # A bucket holds few parts of a kind, as each has a least length and none overlaps another of its kind.
    met = weak.join(other, [row, "scope", "bucket"]).withColumn("gap", gap).filter(F.col("gap") <= reach)
    nearest = lambda r: F.min(F.when((F.col("o_role") == r) & (F.col("gap") >= 0), F.struct("gap", "o")))["o"].alias(r)
    roles = list(COMPLEMENTS)
    met = met.groupBy(row, "role", "kind", "start", "end").agg(
        F.bool_or(~F.col("o_weak") & (F.col("gap") < 0)).alias("inside"), *[nearest(r) for r in roles]
    )
    complete = F.lit(False)
    for role, needs in COMPLEMENTS.items():
        there = F.lit(True)
        for r in needs:
            there &= F.col(r).isNotNull()
        complete |= (F.col("role") == role) & there
    needed = [F.when(F.col("role").isin([k for k, v in COMPLEMENTS.items() if r in v]), F.col(r)) for r in roles]
    partners = F.filter(F.array(*needed), lambda p: p.isNotNull())
    return met.filter(~F.col("inside") & complete).select(row, "kind", "start", "end", partners.alias("partners"))


def scanned(df: DataFrame, text: str = "text", reach: int = REACH, keep_text: bool = True) -> DataFrame:
    """Add ``spans``: (kind, start, end, partners) of every secret, in code points, the end exclusive.

    Spans are ordered by start, then by kind in the order of :data:`KINDS`. ``assign``, ``access``
    and ``hex`` are always reported. A weak part is reported if it lies inside none of these and its
    :data:`COMPLEMENTS` lie within ``reach`` code points of it, in the same scope and apart from it;
    ``partners`` holds the nearest of each. Whole texts are scanned. A null or empty text gets an
    empty array. Every row and column is kept (without ``keep_text`` all but the text), repeated rows
    each for itself; a column named ``spans`` is replaced.
    """
    kept = df.drop(*[c for c in df.columns if c.lower() == "spans" and c != text])
    row, source = free_name(kept, "llm_row"), free_name(kept, "llm_text")
    found_in = free_name(kept, "parts")
    names = [c for c in kept.columns if keep_text or c.lower() != text.lower()]
    kept = kept.withColumn(source, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    parts = F.concat(*[_found(F.col(source), k, p) for k, p, _, _ in KINDS])
    kept = kept.select(*[F.col(f"`{c}`") for c in names], F.monotonically_increasing_id().alias(row), F.col(source), parts.alias(found_in))
    weak = [k for k, _, _, w in KINDS if w]
    linkable = F.exists(found_in, lambda p: p["kind"].isin(weak) & p["counts"]) & (F.size(found_in) > 1)
    breaks = F.when(linkable, F.concat(found_in, _found(F.col(source), "break", BREAK))).otherwise(F.col(found_in))
    # Written once: the row numbers are then the same for every reader.
    kept = stored(kept.withColumn(found_in, breaks).drop(source), "secret-parts")
    spans = _parts(kept.select(row, F.col(found_in).alias("parts")), row)
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    strong = spans.filter("NOT weak").select(row, "kind", "start", "end", none.alias("partners"))
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k[0], i)])[F.col("kind")]
    found = strong.unionByName(_linked(spans, row, reach))
    ordered = F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end", "partners")))
    plain = F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["partners"].alias("partners")))
    of_row = found.groupBy(F.col(row)).agg(plain.alias("spans"))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,partners:array<struct<kind:string,start:int,end:int>>>>")
    out = kept.drop(found_in).join(of_row, row, "left")
    return out.select(*[F.col(f"`{c}`") for c in names], F.coalesce("spans", empty).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _sql(pattern: str) -> str:
    return pattern.replace("'", "''")


def oracle(reach: int = REACH) -> str:
    """The digest of ``documents`` as SQL: the same parts, linked by comparing all parts of a scope."""
    found = " UNION ALL ".join(
        f"""SELECT doc_id, '{k}' AS kind, {n} AS rank, '{role}' AS role, {str(weak).lower()} AS weak, unnest(regexp_extract_all(t, '{_sql(p)}')) AS m,
            unnest(string_split_regex(t, '{_sql(p)}')[:-2]) AS piece, unnest(regexp_extract_all(t, '{_sql(p)}', {2 if k == "assign" else 0})) AS v,
            generate_subscripts(regexp_extract_all(t, '{_sql(p)}'), 1) AS nr FROM d"""
        for n, (k, p, role, weak) in enumerate([*KINDS, ("break", BREAK, "break", False)])
    )
    near = lambda r: f"count(*) FILTER (o.role = '{r}' AND greatest(o.s - w.e, w.s - o.e) BETWEEN 0 AND {reach}) > 0"
    complete = " OR ".join(f"(w.role = '{r}' AND {' AND '.join(near(x) for x in needs)})" for r, needs in COMPLEMENTS.items())
    line = "kind || ':' || s || ':' || e"
    count = lambda k: f"count(*) FILTER (kind = '{k}') AS n_{k}"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ({found}),
      p AS (SELECT *, CAST(sum(length(piece) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY nr) AS BIGINT) AS e FROM f),
      q AS (SELECT doc_id, kind, rank, role, weak, e - length(m) AS s, e FROM p
        WHERE (kind <> 'assign' OR length(v) >= {VALUE}) AND (kind <> 'key' OR (regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')))),
      c AS (SELECT *, count(*) FILTER (kind = 'break') OVER (PARTITION BY doc_id ORDER BY s, e RANGE UNBOUNDED PRECEDING) AS scope FROM q),
      a AS (SELECT * FROM c WHERE kind <> 'break'),
      l AS (SELECT w.doc_id, w.kind, w.rank, w.s, w.e FROM a w JOIN a o ON w.weak AND w.doc_id = o.doc_id AND w.scope = o.scope
        GROUP BY w.doc_id, w.kind, w.rank, w.role, w.s, w.e
        HAVING count(*) FILTER (NOT o.weak AND greatest(o.s - w.e, w.s - o.e) < 0) = 0 AND ({complete})),
      r AS (SELECT doc_id, kind, rank, s, e, true AS base FROM a WHERE NOT weak UNION ALL SELECT doc_id, kind, rank, s, e, false FROM l),
      g AS (SELECT doc_id, {", ".join(map(count, BASE))}, string_agg({line}, ',' ORDER BY s, rank) FILTER (base) AS base,
        string_agg({line}, ',' ORDER BY s, rank) AS spans FROM r GROUP BY doc_id)
      SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
      FROM d LEFT JOIN g ON d.doc_id = g.doc_id"""
