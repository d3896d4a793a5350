"""Quotation linking in conversations (DataFrame and SQL functions only).

A line that starts with ``>`` marks (blanks may stand between) is quoted at the
level of their number. Runs of lines of one level are passages; a passage is
normalised (lower case, single blanks) and hashed. Messages without their
quoted lines give the originals: the whole body, its paragraphs and its lines,
and for passages of several lines or paragraphs every run of as many lines or
paragraphs, hashed alike. A passage belongs to the latest earlier message of its
conversation that holds its hash, and a message replies to the message of its
least deeply quoted passage that was found, or else to the one before it.

Hashes are polynomials over the words modulo three primes, so the hash of a run
is a difference of running sums at its two ends: no run is built as a string, and
a body of L lines gives L rows for each of the lengths that its conversation
quotes (quotes of K different lengths have K * K / 2 lines or more). Two different
passages of as many words have one hash with a chance of about 2 ** -93.

Ranks inside a conversation are taken in two steps (counts of chunks of turns,
then places within a chunk), and so are the last holder of a hash and the last
head of a chain before a message (the last of each chunk carried over the chunks,
then places within a chunk), so a conversation that holds a third of all rows
is spread over its chunks. Depths come from pointer doubling over the messages
that break a plain chain of replies, in rounds that grow with the logarithm of
the longest chain of quotes.

Defined results: a null text counts as empty; a row with a null conversation is
dealt with as a conversation of its own; a null turn sorts first; rows that
repeat a conversation and turn follow each other by role and text; quotes
whose text is not found link nothing but are still taken out of the body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

MARKS = r"^[ \t]*(?:>[ \t]*)+"
PARAGRAPHS = r"\n[ \t]*\n\s*"
CHUNK = 1024
#: Fixed values of the hash: (prime, base). Products of two residues fit a long.
FIELDS = ((2147483647, 48271), (2147483629, 69621), (2147483587, 40692))


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def units(text: Column, cut: str) -> Column:
    """The parts between cuts, normalised, without empty ones."""
    return F.filter(F.transform(F.split(text, cut, -1), normalised), lambda x: x != "")


def polynomials(text: Column) -> Column:
    """The number of words of a normalised text, and its value in each field."""
    start = F.struct(F.lit(0).cast("long").alias("words"), *[F.lit(0).cast("long").alias(f"h{x}") for x in range(len(FIELDS))])
    return F.aggregate(F.split(text, " ", -1), start, lambda held, word: F.struct(
        (held["words"] + 1).alias("words"), *[((held[f"h{x}"] * base + F.pmod(F.xxhash64(word), F.lit(prime))) % prime).alias(f"h{x}") for x, (prime, base) in enumerate(FIELDS)]))


def hash_text(words: Column, values: list[Column]) -> Column:
    return F.concat_ws(":", words.cast("string"), *[v.cast("string") for v in values])


def hashed(text: Column) -> Column:
    # The array round the polynomials makes Spark compute them once, not once a field.
    return F.transform(F.array(polynomials(text)), lambda h: hash_text(h["words"], [h[f"h{x}"] for x in range(len(FIELDS))]))[0]


def power(base: int, prime: int, exponent: Column) -> Column:
    """``base ** exponent`` modulo the prime, by the bits of the exponent (below 2 ** 31)."""
    squares = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("bit"), F.lit(pow(base, 1 << b, prime)).cast("long").alias("value")) for b in range(31)])
    return F.aggregate(squares, F.lit(1).cast("long"), lambda held, s: F.when(exponent.bitwiseAND(s["bit"]) != 0, held * s["value"] % prime).otherwise(held))


def run_hashes(bodies: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, source, hash) of every run of lines or paragraphs of the bodies
    (conv_id, source, body, lines, paragraphs) whose number is 1 or one of
    ``lines`` or ``paragraphs``. A unit adds its value, divided by the base to the
    number of words up to its end, to the running sum; a run's hash is the
    difference of the sums at its ends times the base to the words up to its end."""
    def laid(kind: str, cut: str) -> DataFrame:
        return bodies.select("conv_id", "source", F.lit(kind).alias("kind"), F.array_union(kind, F.array(F.lit(1))).alias("counts"), F.posexplode(units(F.col("body"), cut)).alias("pos", "unit"))

    along = Window.partitionBy("conv_id", "source", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    fields = range(len(FIELDS))
    held = laid("lines", "\n").unionByName(laid("paragraphs", PARAGRAPHS)).withColumn("h", polynomials(F.col("unit"))).drop("unit")
    held = held.withColumn("upto", F.sum("h.words").over(along))
    held = held.withColumns({f"t{x}": F.col(f"h.h{x}") * power(pow(base, -1, prime), prime, F.col("upto")) % prime for x, (prime, base) in enumerate(FIELDS)})
    held = held.withColumns({f"s{x}": F.sum(f"t{x}").over(along) for x in fields})
    held = scratch.table(held.select("conv_id", "source", "kind", "counts", "pos", F.col("h.words").alias("words"), "upto", *[f"t{x}" for x in fields], *[f"s{x}" for x in fields]), "quotes-units")
    place = ["conv_id", "source", "kind", "pos"]
    starts = (held.select("conv_id", "source", "kind", "pos", (F.col("upto") - F.col("words")).alias("before"), *[(F.col(f"s{x}") - F.col(f"t{x}")).alias(f"b{x}") for x in fields], F.explode("counts").alias("n"))
              .withColumn("pos", F.col("pos") + F.col("n") - 1))
    ends = held.select(*place, "upto", *[f"s{x}" for x in fields], *[power(base, prime, F.col("upto")).alias(f"p{x}") for x, (prime, base) in enumerate(FIELDS)])
    value = [F.pmod(F.col(f"s{x}") - F.col(f"b{x}"), F.lit(prime)) * F.col(f"p{x}") % prime for x, (prime, _) in enumerate(FIELDS)]
    return starts.join(ends, place).select("conv_id", "source", hash_text(F.col("upto") - F.col("before"), value).alias("hash"))


def parse(text: Column) -> dict[str, Column]:
    """``body`` (the text without quoted lines) and ``passages`` (level, hash,
    numbers of lines and paragraphs)."""
    lines = F.split(F.translate(text, "\x02\x03", "  "), "\n", -1)
    marked = F.transform(lines, lambda x: F.struct(level(x).alias("level"), F.regexp_replace(x, MARKS, "").alias("line")))
    body = F.regexp_replace(F.array_join(F.transform(F.filter(marked, lambda x: x["level"] == 0), lambda x: x["line"]), "\n"), r"^\s+|\s+$", "")
    # A mark with the level stands where the level changes; the rest are line ends.
    # The array round the lines makes Spark compute them once, not once a line.
    def cut(all_lines: Column) -> Column:
        return F.transform(all_lines, lambda x, i: F.concat(
            F.when((i > 0) & (F.get(all_lines, i - 1)["level"] == x["level"]), F.lit("\n")).otherwise(F.concat(F.lit("\x02"), x["level"].cast("string"), F.lit("\x03"))), x["line"]))
    runs = F.transform(F.filter(F.split(F.array_join(F.flatten(F.transform(F.array(marked), cut)), ""), "\x02"), lambda r: ~r.startswith("0\x03") & (r != "")),
                       lambda r: F.struct(F.substring_index(r, "\x03", 1).cast("int").alias("level"), F.substring_index(r, "\x03", -1).alias("text")))
    passages = F.transform(F.filter(runs, lambda r: normalised(r["text"]) != ""), lambda r: F.struct(
        r["level"].alias("level"), hashed(normalised(r["text"])).alias("hash"), F.size(units(r["text"], "\n")).alias("lines"), F.size(units(r["text"], PARAGRAPHS)).alias("paragraphs")))
    return {"body": body, "passages": passages}


def ranked(df: DataFrame, group: str, turn: str, *ties: str) -> DataFrame:
    """``df`` with ``rank`` (from 0) in each group by turn and the ties: places
    within chunks of turns plus the rows of the chunks before."""
    df = df.withColumn("_chunk", F.floor(F.col(turn) / CHUNK))
    order = Window.partitionBy(group).orderBy("_chunk")
    sizes = df.groupBy(group, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    own = F.row_number().over(Window.partitionBy(group, "_chunk").orderBy(turn, *ties)) - 1
    placed = df.withColumn("_own", own).alias("l").join(before.alias("r"), F.col(f"l.{group}").eqNullSafe(F.col(f"r.{group}")) & F.col("l._chunk").eqNullSafe(F.col("r._chunk")))
    return placed.select("l.*", (F.col("l._own") + F.col("r._before")).cast("long").alias("rank")).drop("_chunk", "_own")


def last_before(points: DataFrame, marks: DataFrame, keys: list[str], at: str, value: str, same: bool) -> DataFrame:
    """``points`` with ``value`` of the last of the marks (keys, ``at``, ``value``
    growing with ``at``) of their keys before their ``at``, or at it if ``same``."""
    kind = marks.schema[value].dataType
    every = (points.withColumns({value: F.lit(None).cast(kind), "_point": F.lit(True)})
             .unionByName(marks.select(*keys, at, value, F.lit(False).alias("_point")), allowMissingColumns=True).withColumn("_chunk", F.floor(F.col(at) / CHUNK)))
    chunks = every.groupBy(*keys, "_chunk").agg(F.max(value).alias("_top"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select(*keys, "_chunk", F.max("_top").over(before).alias("_carried"))
    within = Window.partitionBy(*keys, "_chunk").orderBy(at, F.col("_point") if same else ~F.col("_point")).rowsBetween(Window.unboundedPreceding, 0)
    placed = every.withColumn("_own", F.max(value).over(within)).filter("_point").join(carried, [*keys, "_chunk"])
    return placed.select(*points.columns, F.coalesce("_own", "_carried").alias(value))


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, body, n_passages, n_linked,
    position (place in reply order: after the message that it answers),
    reply_to (position of that message; null for the first), depth (replies
    from the first message)."""
    scratch = Scratch(messages.sparkSession)
    source = messages.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = ranked(source.filter("conv_id is not null"), "conv_id", "turn", "role", "text")
    lone = source.filter("conv_id is null").withColumn("rank", F.lit(0).cast("long"))
    parts = parse(F.col("text"))
    rows = scratch.table(known.unionByName(lone).select("conv_id", "turn", "role", "rank", parts["body"].alias("body"), parts["passages"].alias("passages")), "quotes-rows")

    passages = rows.filter("conv_id is not null and size(passages) > 0").select("conv_id", "rank", F.explode("passages").alias("p")).select("conv_id", "rank", "p.*")
    quoted = passages.select("conv_id", "rank", "level", "hash").distinct()
    # The lengths that a conversation quotes are the only ones that its originals need.
    quoting = passages.groupBy("conv_id").agg(F.collect_set("lines").alias("lines"), F.collect_set("paragraphs").alias("paragraphs"))
    bodies = rows.join(quoting, "conv_id").select("conv_id", F.col("rank").alias("source"), "body", "lines", "paragraphs").filter(normalised(F.col("body")) != "")
    whole = bodies.select("conv_id", "source", hashed(normalised(F.col("body"))).alias("hash"))
    originals = whole.unionByName(run_hashes(bodies, scratch)).distinct()
    # The latest earlier holder of a hash: each quote and holder is a point on
    # the conversation's line, so ordered passes replace a join of all pairs.
    holders = originals.select("conv_id", "hash", F.col("source").alias("rank"), "source")
    linked = last_before(quoted, holders, ["conv_id", "hash"], "rank", "source", same=False).filter("source is not null")
    parents = (linked.groupBy("conv_id", "rank").agg(F.count(F.lit(1)).alias("n_linked"), F.max(F.struct(-F.col("level"), "source"))["source"].alias("quoted")))
    parents = scratch.table(parents, "quotes-parents")

    # Messages that answer another than the one before start a chain of their own.
    heads = parents.filter("quoted != rank - 1").select("conv_id", F.col("rank").alias("head"), "quoted")
    heads = heads.unionByName(heads.select("conv_id", F.lit(0).cast("long").alias("head"), F.lit(-1).cast("long").alias("quoted")).distinct())
    heads = scratch.table(heads, "quotes-heads")
    answers = heads.filter("head > 0").select("conv_id", "head", F.col("quoted").alias("at"))
    up = (last_before(answers, heads.select("conv_id", F.col("head").alias("at"), F.col("head").alias("up")), ["conv_id"], "at", "up", same=True)
          .select("conv_id", "head", "up", (F.col("at") - F.col("up") + 1).alias("steps")))
    up, turn_no = scratch.table(up, "quotes-up-0"), 0
    while up.filter("up > 0").limit(1).count():
        over = up.select("conv_id", F.col("head").alias("up"), F.col("up").alias("further"), F.col("steps").alias("more"))
        turn_no += 1
        up = scratch.table(up.join(over, ["conv_id", "up"], "left").select("conv_id", "head", F.coalesce("further", F.lit(0)).alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")), f"quotes-up-{turn_no}")
    # A message's chain: the last head at or before it, in chunks again.
    depths = up.select("conv_id", "head", F.col("steps").alias("depth"))
    chains = (heads.select("conv_id", "head").join(depths, ["conv_id", "head"], "left")
              .select("conv_id", F.col("head").alias("rank"), F.struct("head", F.coalesce("depth", F.lit(0)).alias("at")).alias("chain")))
    some = rows.join(parents, ["conv_id", "rank"], "left")
    chained = last_before(some.filter("conv_id is not null"), chains, ["conv_id"], "rank", "chain", same=True).sortWithinPartitions("conv_id", "rank")
    placed = (chained.unionByName(rows.filter("conv_id is null"), allowMissingColumns=True)
              .withColumn("depth", F.coalesce(F.col("chain.at") + F.col("rank") - F.col("chain.head"), F.col("rank"))))
    reply = F.when(F.col("rank") > 0, F.coalesce("quoted", F.col("rank") - 1))
    return placed.select("conv_id", "turn", "role", "body", F.size("passages").cast("long").alias("n_passages"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
                         F.col("rank").alias("position"), reply.alias("reply_to"), F.col("depth").cast("long").alias("depth"))


SQL = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
         CASE WHEN conv_id IS NULL THEN 0 ELSE row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 END AS rank
  FROM conversations),
l AS (
  SELECT *, length(regexp_replace(regexp_extract(line, '^[ \t]*(?:>[ \t]*)+'), '[^>]', '', 'g')) AS level, regexp_replace(line, '^[ \t]*(?:>[ \t]*)+', '') AS content
  FROM (SELECT conv_id, turn, role, rank, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM m)),
b AS (
  SELECT conv_id, turn, role, rank, text, regexp_replace(coalesce(string_agg(content, chr(10) ORDER BY pos) FILTER (WHERE level = 0), ''), '^\s+|\s+$', '', 'g') AS body
  FROM l GROUP BY ALL),
r AS (
  SELECT conv_id, rank, level, pos, content, sum(starts) OVER (PARTITION BY conv_id, rank ORDER BY pos) AS run
  FROM (SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY conv_id, rank ORDER BY pos) THEN 0 ELSE 1 END AS starts FROM l WHERE conv_id IS NOT NULL)),
p AS (
  SELECT conv_id, rank, level, string_agg(content, chr(10) ORDER BY pos) AS raw FROM r WHERE level > 0 GROUP BY conv_id, rank, level, run),
q AS (
  SELECT conv_id, rank, level, md5(trim(regexp_replace(lower(raw), '\s+', ' ', 'g'))) AS hash, len(list_filter(list_transform(string_split(raw, chr(10)), lambda x: trim(regexp_replace(lower(x), '\s+', ' ', 'g'))), lambda x: x <> '')) AS lines,
         len(list_filter(list_transform(regexp_split_to_array(raw, '\n[ \t]*\n\s*'), lambda x: trim(regexp_replace(lower(x), '\s+', ' ', 'g'))), lambda x: x <> '')) AS paragraphs
  FROM p WHERE trim(regexp_replace(lower(raw), '\s+', ' ', 'g')) <> ''),
u AS (
  SELECT conv_id, rank, 'lines' AS kind, list_filter(list_transform(string_split(body, chr(10)), lambda x: trim(regexp_replace(lower(x), '\s+', ' ', 'g'))), lambda x: x <> '') AS parts FROM b WHERE conv_id IN (SELECT conv_id FROM q)
  UNION ALL
  SELECT conv_id, rank, 'paragraphs', list_filter(list_transform(regexp_split_to_array(body, '\n[ \t]*\n\s*'), lambda x: trim(regexp_replace(lower(x), '\s+', ' ', 'g'))), lambda x: x <> '') FROM b WHERE conv_id IN (SELECT conv_id FROM q)),
c AS (
  SELECT conv_id, 'lines' AS kind, lines AS n FROM q UNION SELECT conv_id, 'paragraphs', paragraphs FROM q
  UNION SELECT conv_id, kind, 1 FROM q, (VALUES ('lines'), ('paragraphs')) t(kind)),
o AS (
  SELECT DISTINCT conv_id, source, md5(piece) AS hash
  FROM (SELECT conv_id, rank AS source, trim(regexp_replace(lower(body), '\s+', ' ', 'g')) AS piece FROM b WHERE conv_id IN (SELECT conv_id FROM q)
        UNION ALL
        SELECT u.conv_id, u.rank, unnest(list_transform(range(1, len(parts) - n + 2), lambda i: array_to_string(parts[i:i + n - 1], ' '))) FROM u JOIN c ON c.conv_id = u.conv_id AND c.kind = u.kind)
  WHERE piece <> ''),
k AS (SELECT q.conv_id, q.rank, q.level, q.hash, max(o.source) AS source FROM (SELECT DISTINCT conv_id, rank, level, hash FROM q) q JOIN o ON o.conv_id = q.conv_id AND o.hash = q.hash AND o.source < q.rank GROUP BY ALL),
f AS (SELECT conv_id, rank, count(*) AS n_linked, arg_max(source, -level * 1000000000 + source) AS quoted FROM k GROUP BY ALL),
h AS (SELECT conv_id, rank AS head, quoted FROM f WHERE quoted <> rank - 1),
d AS (
  SELECT b.conv_id, b.rank, coalesce(f.quoted, b.rank - 1) AS up, 0 AS steps, b.rank AS self FROM b LEFT JOIN f ON f.conv_id = b.conv_id AND f.rank = b.rank WHERE b.conv_id IN (SELECT conv_id FROM h) AND b.rank > 0
  UNION ALL
  SELECT d.conv_id, d.up, coalesce(f.quoted, d.up - 1), d.steps + 1, d.self FROM d LEFT JOIN f ON f.conv_id = d.conv_id AND f.rank = d.up WHERE d.up > 0),
e AS (SELECT conv_id, self AS rank, max(steps) + 1 AS depth FROM d GROUP BY ALL),
n AS (SELECT conv_id, rank, count(*) AS n_passages FROM q GROUP BY ALL)
SELECT b.conv_id, b.turn, b.role, b.body, coalesce(n.n_passages, 0) AS n_passages, coalesce(f.n_linked, 0) AS n_linked, b.rank AS position,
       CASE WHEN b.rank > 0 THEN coalesce(f.quoted, b.rank - 1) END AS reply_to, coalesce(e.depth, b.rank) AS depth
FROM b LEFT JOIN f ON f.conv_id = b.conv_id AND f.rank = b.rank LEFT JOIN e ON e.conv_id = b.conv_id AND e.rank = b.rank LEFT JOIN n ON n.conv_id = b.conv_id AND n.rank = b.rank
"""
