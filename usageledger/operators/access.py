"""Row-level access: which name patterns a caller has, and the rows they allow."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageledger.context import REPORT_SERVICE_ROLE, ReportContext
from usageledger.functions.patterns import alternations, full_match, full_match_column, is_plain
from usageledger.operators.skew import hot_rows_of
from usageledger.session import staged, staged_with

#: Patterns of up to so many characters in all become literals of the plan; more are read by the tasks.
LITERAL_CHARACTERS = 20_000
#: Stands between the names of two columns that one expression tests together.
_BETWEEN = "\x00"

DATABASE, WAREHOUSE = "database_pattern", "warehouse_pattern"


def _rows_of_caller(access_map: DataFrame, ctx: ReportContext) -> DataFrame:
    account, role = F.lower("account"), F.lower("role")
    for_user = (account == ctx.user.lower()) & F.col("role").isNull()
    for_role = F.col("account").isNull() & role.isin([r.lower() for r in ctx.roles])
    return access_map.filter(for_user | for_role).select(
        F.col("database").alias(DATABASE),
        F.col("warehouse").alias(WAREHOUSE),
        F.col("role").isNull().alias("_user"),
    )


def resolve_access_patterns(access_map: DataFrame, ctx: ReportContext) -> DataFrame:
    """Distinct (database_pattern, warehouse_pattern) of the caller.

    Rows for the user alone win over rows for the caller's roles. Rows naming
    both never apply. Rows with a missing pattern count as a user's rows but
    allow nothing; a caller without rows gets nothing.
    """
    own = _rows_of_caller(access_map, ctx)
    by_user = own.agg(F.max("_user").alias("_user")).scalar()
    return (
        own.filter(F.col("_user") == by_user)
        .filter(F.col(DATABASE).isNotNull() & F.col(WAREHOUSE).isNotNull())
        .select(DATABASE, WAREHOUSE)
        .distinct()
    )


@dataclass(frozen=True)
class CallerPatterns:
    """A caller's patterns, read once: the relation, and its rows where a plan may hold them (else None)."""

    frame: DataFrame
    literals: frozenset[tuple[str, str]] | None

    def rows(self, columns: Sequence[str]) -> set[tuple] | None:
        if self.literals is None:
            return None
        at = [(DATABASE, WAREHOUSE).index(c) for c in columns]
        return {tuple(row[k] for k in at) for row in self.literals}


def caller_patterns(access_map: DataFrame, ctx: ReportContext, literal_characters: int = LITERAL_CHARACTERS) -> CallerPatterns:
    """resolve_access_patterns in one job, for all views of a caller.

    The driver reads the rows of the map that name the caller or their roles, as far
    as a plan may hold them; of more, only the relation is kept.
    """
    of_caller = _rows_of_caller(access_map, ctx).limit(literal_characters + 1).collect()
    frame = resolve_access_patterns(access_map, ctx)
    for_user = any(r["_user"] for r in of_caller)
    found = {(r[DATABASE], r[WAREHOUSE]) for r in of_caller if r["_user"] == for_user and None not in (r[DATABASE], r[WAREHOUSE])}
    fits = len(of_caller) <= literal_characters and sum(len(t) for row in found for t in row) <= literal_characters
    return CallerPatterns(frame, frozenset(found) if fits else None)


Patterns = DataFrame | CallerPatterns


def _tested(columns: Sequence[str]) -> Column:
    """One text of the columns; missing when one of them is."""
    return F.concat(*_between([F.col(c) for c in columns]))


def _between(parts: Sequence) -> list:
    return [x for part in parts for x in (F.lit(_BETWEEN), part)][1:]


def _scope(
    df: DataFrame,
    patterns: Patterns,
    tests: Sequence[tuple[str, str]],
    every: bool,
    literal_characters: int,
) -> DataFrame:
    """Rows for which some pattern row passes the tests (column, pattern column).

    Patterns become a literal predicate without a join: plain names one set,
    others alternations, one regular expression for many of them. Where several columns must match the same
    pattern row, they are tested as one text. Patterns beyond
    ``literal_characters``, which neither a plan nor an expression should hold,
    meet the distinct names in a join instead.
    """
    used = list(dict.fromkeys(p for _, p in tests))
    joined = every and len(tests) > 1
    # columns that are tested as one text, or each on its own against the expressions of their pattern column
    subjects = [[c for c, _ in tests]] if joined else [[c for c, q in tests if q == p] for p in used]
    frame = patterns.frame if isinstance(patterns, CallerPatterns) else patterns
    wanted = frame.select(*used).distinct()
    found = patterns.rows(used) if isinstance(patterns, CallerPatterns) else None
    if found is None:
        found = {tuple(r) for r in wanted.limit(literal_characters + 1).collect()}
    if len(found) > literal_characters or sum(len(t or "") for row in found for t in row) > literal_characters:
        return _scope_by_names(df, wanted, used, subjects, joined)
    texts = [found] if joined else [{(row[k],) for row in found} for k in range(len(used))]
    allowed = F.lit(False)
    for patterns_of, columns in zip(texts, subjects):
        plain = sorted(t for t in patterns_of if all(map(is_plain, t)))
        rest = sorted(patterns_of.difference(plain))
        for subject in [_tested(columns)] if joined else [F.col(c) for c in columns]:
            if plain:
                allowed = allowed | subject.isin([_BETWEEN.join(t) for t in plain])
            for e in alternations(_BETWEEN.join(f"(?:{x})" for x in t) if joined else t[0] for t in rest):
                allowed = allowed | full_match(subject, e)
    return df.filter(allowed)


def _literal_start(pattern: Column) -> Column:
    """What every text that the pattern matches starts with, as far as that is plain to see."""
    start = F.regexp_extract(pattern, r"^[\w \-]*", 0)
    behind = F.substring(pattern, F.length(start) + 1, F.lit(1))
    optional = F.length(start) - F.when(behind.isin("?", "*", "{"), 1).otherwise(0)
    return F.when(F.contains(pattern, F.lit("|")), "").otherwise(F.left(start, F.greatest(optional, F.lit(0))))


#: Length of the shortest pieces of text that names and patterns are indexed by.
PIECE = 3
#: Lengths of pieces. A pattern has those of the greatest length that its longest run holds: the longer, the fewer names share one.
PIECES = (3, 4, 6, 8, 12, 16, 24, 32)


def _plain_text(pattern: Column) -> Column:
    """The pattern with a gap for all that isn't there in every match as it is written; empty where that can't be told."""
    gap = "\x00"
    odd = F.regexp_like(pattern, F.lit(r"\(\?[^:]|\\[QE]|\[[^\]]*\[|\[\^?\]"))
    plain = F.regexp_replace(pattern, r"(?s)\\.", gap)
    plain = F.regexp_replace(plain, r"\[[^\]]*\]", gap)
    plain = F.regexp_replace(plain, r"\(\?:", "(")
    plain = F.regexp_replace(plain, r"[^()](?:[?*]|\{[^}]*\})", gap)
    for _ in range(4):  # groups in groups, the inner ones first
        plain = F.regexp_replace(plain, r"\([^()]*\)(?:[?*]|\{[^}]*\})?", gap)
    return F.when(odd | F.regexp_like(plain, F.lit(r"[|()\[\]]")), "").otherwise(plain)


def _runs(plain: Column) -> Column:
    return F.split(plain, r"[^\w \-]+")


def _pieces_of(plain: Column, size: Column | int) -> Column:
    return F.array_distinct(F.flatten(F.transform(_runs(plain), lambda r: pieces(r, size))))


def required_pieces(pattern: Column, size: int = PIECE) -> Column:
    """Distinct pieces, trigrams if not told otherwise, that every text the pattern matches contains.

    They come from runs of plain characters outside of groups and classes. What may be
    missing, or read otherwise, counts for nothing: characters under a quantifier,
    alternatives, escapes; a pattern with flags or quotes has no pieces at all.
    """
    return _pieces_of(_plain_text(pattern), size)


def _piece_size(plain: Column) -> Column:
    """The greatest of PIECES that the longest run holds; missing when none does."""
    longest = F.array_max(F.transform(_runs(plain), F.length))
    return F.array_max(F.filter(F.array(*map(F.lit, PIECES)), lambda n: n <= longest))


def pieces(text: Column, size: Column | int = PIECE) -> Column:
    """The pieces of a text, trigrams if not told otherwise, as often as they occur."""
    size = F.lit(size) if isinstance(size, int) else size
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda k: F.substring(text, k, size))


#: The words of a name.
_WORD = "[A-Za-z0-9]+"


def _whole_words(plain: Column, start: Column) -> Column:
    behind = F.substring(plain, start + 1, F.length(plain))
    return F.array_distinct(F.regexp_extract_all(behind, F.lit(rf"(?<=[_ \-]){_WORD}(?=[_ \-]|\z)"), F.lit(0)))


def required_words(pattern: Column) -> Column:
    """Distinct whole words, behind its literal start, that every text the pattern matches has: others end them on both sides."""
    return _whole_words(_plain_text(pattern), F.length(_literal_start(pattern)))


#: How a pattern finds its names: by its start, by a word, by a piece, or among all of them.
_START, _A_WORD, _PIECE, _ALL = "s", "w", "t", ""


@dataclass(frozen=True)
class Kinds:
    """Which keys patterns ask for; names need no others: lengths of starts and of pieces, words, and the key of all names."""

    starts: tuple[int, ...] = ()
    pieces: tuple[int, ...] = PIECES
    words: bool = True
    every: bool = True


def pattern_keys(patterns: DataFrame) -> DataFrame:
    """(e, _keys, _start, _size): the keys of an expression, each of them a key of every name it matches.

    ``patterns`` has e and first, the pattern that the keys are taken from: its literal
    start and the words behind it, without both its pieces, without these the key of
    all names. _start is the length of the start, _size that of the pieces.
    """
    found = patterns.select("e", _literal_start(F.col("first")).alias("_s"), _plain_text(F.col("first")).alias("_plain"))
    found = found.select("e", "_s", "_plain", _whole_words(F.col("_plain"), F.length("_s")).alias("_w"), _piece_size(F.col("_plain")).alias("_size"))
    shown = F.concat(
        F.when(F.col("_s") != "", F.array(F.concat(F.lit(_START), "_s"))).otherwise(F.array().cast("array<string>")),
        F.transform("_w", lambda w: F.concat(F.lit(_A_WORD), w)),
    )
    inner = F.transform(_pieces_of(F.col("_plain"), F.col("_size")), lambda t: F.concat(F.lit(_PIECE), t))
    bare = F.when(F.size(shown) > 0, shown).when(F.col("_size").isNotNull(), inner).otherwise(F.array(F.lit(_ALL)))
    return found.select("e", bare.alias("_keys"), F.length("_s").alias("_start"), F.when(F.size(shown) == 0, F.col("_size")).alias("_size"))


def _kinds(keys: DataFrame) -> Kinds:
    of = lambda kind: F.exists("_keys", lambda k: F.left(k, F.lit(1)) == kind)
    sets = [F.collect_set(F.when(F.col("_start") > 0, F.col("_start"))), F.collect_set("_size")]  # no more than a name is long
    starts, sizes, words, every = keys.agg(*sets, F.bool_or(of(_A_WORD)), F.bool_or(of(_ALL))).first()
    return Kinds(tuple(sorted(starts)), tuple(sorted(sizes)), bool(words), bool(every))


def _name_keys(subject: Column, kinds: Kinds) -> Column:
    """Every key under which patterns may find a name."""
    starts = F.filter(F.array(*[F.lit(n) for n in kinds.starts]).cast("array<int>"), lambda n: n <= F.length(subject))
    keys = [F.transform(starts, lambda n: F.concat(F.lit(_START), F.left(subject, n)))]
    if kinds.words:
        keys.append(F.transform(F.regexp_extract_all(subject, F.lit(_WORD), F.lit(0)), lambda w: F.concat(F.lit(_A_WORD), w)))
    keys += [F.transform(pieces(subject, n), lambda t: F.concat(F.lit(_PIECE), t)) for n in kinds.pieces]
    if kinds.every:
        keys.append(F.array(F.lit(_ALL)))
    return F.array_distinct(F.concat(*keys))


def _rows_each(names: DataFrame) -> int:
    """How many rows of names with their keys a task may hold, by their schema."""
    return hot_rows_of(names.withColumn("_key", F.lit("")))


def _dealt_out(df: DataFrame, rows: int, each: int, *by: str) -> DataFrame:
    """df with tasks of about ``each`` rows, where Spark's own choice, made by compressed bytes, may give them more."""
    spark = df.sparkSession
    tasks = -(-rows // each)
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *by) if tasks > least else df


@dataclass(frozen=True)
class Size:
    """How many names there are, and how many characters they have in all."""

    names: int
    characters: int

    def keys(self, kinds: Kinds) -> int:
        """At most so many rows are the names with their keys."""
        words = -(-(self.characters + self.names) // 2) if kinds.words else 0
        return self.names * (len(kinds.starts) + kinds.every) + words + self.characters * len(kinds.pieces)


def _listed(
    patterns: DataFrame, names: DataFrame, slots: int, hot_rows: int | None = None, size: Size | None = None
) -> tuple[DataFrame, DataFrame, Kinds]:
    """(e, _key, _slot) as in indexed_patterns; (_key, _fan), the names' keys of many rows, with their slots; the kinds of keys.

    The names' keys are counted once, by tasks of as many names as have keys that one
    may hold, if the size of the names is given. Kept of the counts are those of keys
    that patterns have and of keys of many names, which are few.
    """
    keys = staged(pattern_keys(patterns), "pattern-keys")
    kinds = _kinds(keys)
    hot_rows = hot_rows or _rows_each(names)
    if size is not None:
        names = _dealt_out(names, size.keys(kinds), _rows_each(names), "_subject")
    each = keys.select("e", F.explode("_keys").alias("_key"))
    held = names.select(F.explode(_name_keys(F.col("_subject"), kinds)).alias("_key"), F.lit(1).alias("n"), F.lit(False).alias("_asked"))
    counts = held.unionByName(each.select("_key", F.lit(0).alias("n"), F.lit(True).alias("_asked")))
    counts = counts.groupBy("_key").agg(F.sum("n").alias("n"), F.bool_or("_asked").alias("_asked")).filter(F.col("_asked") | (F.col("n") > hot_rows))
    counts = staged(counts, "name-keys")
    # as many as the patterns' keys: by the size of its file Spark would broadcast what takes many times that in memory
    rarest = each.join(counts.select("_key", "n").hint("merge"), "_key")
    rarest = staged(rarest.groupBy("e").agg(F.min_by("_key", F.struct("n", "_key")).alias("_key")), "rarest-keys")
    # names that are many under a key which no pattern has chosen need no slot at all
    many = counts.filter((F.col("n") > hot_rows) | (F.col("_key") == _ALL)).select("_key", "n")
    used = rarest.join(F.broadcast(many), "_key", "left_semi").select("_key").distinct().withColumn("_used", F.lit(True))
    many = many.join(F.broadcast(used), "_key", "left")
    fan = F.greatest(F.ceil(F.col("n") / F.lit(hot_rows)).cast("int"), F.when(F.col("_key") == _ALL, slots))
    hot = many.select("_key", F.when(F.col("_used"), fan).otherwise(0).alias("_fan"))
    dealt = F.explode(F.sequence(F.lit(0), F.coalesce("_fan", F.lit(1)) - 1))
    return rarest.join(F.broadcast(hot), "_key", "left").select("e", "_key", dealt.alias("_slot")), hot, kinds


def indexed_patterns(patterns: DataFrame, names: DataFrame, slots: int, hot_rows: int | None = None) -> DataFrame:
    """(e, _key, _slot): expressions with the key under which they meet names.

    ``patterns`` has e and first, the pattern whose keys count; ``names`` has _subject.
    A pattern meets names under the rarest of its keys among the names. Only a pattern
    without a start, words and pieces meets all names, which are dealt out over slots, as
    are the names of a key with more than hot_rows names.
    """
    return _listed(patterns, names, slots, hot_rows)[0]


def indexed_names(names: DataFrame, sizes: Sequence[int], slots: int, kinds: Kinds | None = None, hot: DataFrame | None = None) -> DataFrame:
    """names with every key (_key, _slot) under which patterns may find them; ``sizes`` are the lengths of the patterns' starts.

    Names of a key in ``hot`` are dealt out over its slots; if it has none, no pattern looks there.
    """
    kinds = replace(kinds or Kinds(), starts=tuple(sorted(sizes)))
    keyed = names.withColumn("_key", F.explode(_name_keys(F.col("_subject"), kinds)))
    if hot is None:
        keyed = keyed.withColumn("_fan", F.when(F.col("_key") == _ALL, slots))
    else:
        keyed = keyed.join(F.broadcast(hot), "_key", "left").filter(F.coalesce("_fan", F.lit(1)) > 0)
    slot = F.coalesce(F.pmod(F.xxhash64("_subject"), F.col("_fan")).cast("int"), F.lit(0))
    return keyed.withColumn("_slot", slot).drop("_fan")


def _scope_by_names(
    df: DataFrame, wanted: DataFrame, used: Sequence[str], subjects: Sequence[Sequence[str]], joined: bool
) -> DataFrame:
    """The same rows, found through the distinct names: names meet patterns by an inverted list of starts, words and pieces."""
    slots = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = [F.concat(F.lit("(?:"), F.col(p), F.lit(")")) for p in used]
    each = [(F.concat(*_between(grouped)), used[0])] if joined else [(F.col(p), p) for p in used]
    columns = list(dict.fromkeys(c for cs in subjects for c in cs))
    visible = None
    for (expression, first), own in zip(each, subjects):
        patterns = wanted.select(expression.alias("e"), F.col(first).alias("first")).filter(F.col("e").isNotNull()).distinct()
        patterns = patterns.repartition(slots, "e")  # small rows, but dear to read: not in a few tasks
        for subject, alone in [(_tested(own), None)] if joined else [(F.col(c), c) for c in own]:
            names = df.select(*columns).distinct().withColumn("_subject", subject).filter(F.col("_subject").isNotNull())
            names = names.drop(alone) if alone else names  # a column that is the subject is carried once
            names, found = staged_with(names, "names", names=F.count(F.lit(1)), characters=F.coalesce(F.sum(F.length("_subject")), F.lit(0)))
            size = Size(**found)
            listed, hot, kinds = _listed(patterns, names, slots, size=size)
            matches = full_match_column(F.col("_subject"), F.col("e"))
            same = [F.col(f"n.{c}") == F.col(f"p.{c}") for c in ("_key", "_slot")]
            rows, most = size.keys(kinds), _rows_each(names)
            keyed = indexed_names(_dealt_out(names, rows, most, "_subject"), kinds.starts, slots, kinds, hot)
            # the names' keys follow: a repartition of theirs would be moved behind the join
            listed = _dealt_out(listed, rows, most, "_key", "_slot")
            met = keyed.alias("n").join(listed.alias("p"), same[0] & same[1] & matches, "left_semi")
            seen = met.select(*[F.col("_subject" if c == alone else c).alias(f"_seen_{c}") for c in columns])
            visible = seen if visible is None else visible.unionByName(seen)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_seen_{c}")) for c in columns])
    return df.join(visible.distinct(), same, "left_semi")


def scope_rows_single(
    df: DataFrame, patterns: Patterns, column: str, pattern: str = DATABASE, literal_characters: int = LITERAL_CHARACTERS
) -> DataFrame:
    """One column must match some pattern."""
    return _scope(df, patterns, [(column, pattern)], True, literal_characters)


def scope_rows_either(
    df: DataFrame,
    patterns: Patterns,
    warehouse: str = "warehouse_name",
    database: str = "database_name",
    literal_characters: int = LITERAL_CHARACTERS,
) -> DataFrame:
    """The warehouse or the database must match."""
    return _scope(df, patterns, [(warehouse, WAREHOUSE), (database, DATABASE)], False, literal_characters)


def scope_rows_both(
    df: DataFrame,
    patterns: Patterns,
    warehouse: str = "warehouse_name",
    database: str = "database_name",
    literal_characters: int = LITERAL_CHARACTERS,
) -> DataFrame:
    """Warehouse and database must match the same pattern row."""
    return _scope(df, patterns, [(warehouse, WAREHOUSE), (database, DATABASE)], True, literal_characters)


def scope_rows_two_columns(
    df: DataFrame,
    patterns: Patterns,
    first: str,
    second: str,
    pattern: str = DATABASE,
    literal_characters: int = LITERAL_CHARACTERS,
) -> DataFrame:
    """Either of two columns must match one pattern."""
    return _scope(df, patterns, [(first, pattern), (second, pattern)], False, literal_characters)


def role_gate(df: DataFrame, ctx: ReportContext, role: str = REPORT_SERVICE_ROLE) -> DataFrame:
    """Everything for holders of the role, nothing for others."""
    return df.filter(F.lit(ctx.has_role(role)))


def role_membership_scope(df: DataFrame, ctx: ReportContext, column: str = "grantee_name") -> DataFrame:
    """Rows granted to one of the caller's roles."""
    return df.filter(F.col(column).isin(sorted(set(ctx.roles))))


def any_pattern_gate(df: DataFrame, patterns: Patterns) -> DataFrame:
    """All distinct rows for callers with at least one database pattern."""
    if isinstance(patterns, CallerPatterns) and patterns.literals is not None:
        allowed = bool(patterns.literals)
    else:
        frame = patterns.frame if isinstance(patterns, CallerPatterns) else patterns
        allowed = not frame.filter(F.col(DATABASE).isNotNull()).isEmpty()
    return df.filter(F.lit(allowed)).distinct()


