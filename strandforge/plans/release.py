"""Releases: loading sequences and cross-references by version, their statistics and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import identifiers
from ..operators import relational as R

#: Longer sequences are kept in seq_long.
SHORT = 4000


def sequence_of(df_prefix: str = "") -> Column:
    return F.coalesce(F.col(f"{df_prefix}seq_short"), F.col(f"{df_prefix}seq_long"))


def load_sequences(rna: DataFrame, staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new rna rows, staged rows with their upi).

    rna: id, upi, md5, len, seq_short, seq_long. staged: md5, len, seq_short,
    seq_long and any other columns. A staged row has a known upi only if md5,
    length and sequence agree. Of the rest, an md5 with one sequence gets the next id;
    an md5 with several stays without one and isn't loaded.
    """
    staged = staged.distinct()
    known = rna.select("upi", F.col("md5").alias("_md5"), F.col("len").alias("_len"), sequence_of().alias("_seq"))
    on = (F.col("md5") == F.col("_md5")) & (F.col("len") == F.col("_len")) & (sequence_of() == F.col("_seq"))
    joined = staged.join(known, on, "left").drop("_md5", "_len", "_seq")
    kinds = joined.groupBy("md5").agg(F.count_distinct(sequence_of()).alias("_kinds"), F.max("upi").alias("_known"))
    fresh = kinds.where("_kinds = 1 AND _known IS NULL").select("md5")
    last = rna.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    numbered = R.dense_ids(fresh, "md5", "id", last + 1).withColumn("_new", identifiers.urs(F.col("id")))
    filled = joined.join(numbered, "md5", "left").withColumn("upi", F.coalesce("upi", "_new"))
    first = filled.where("_new IS NOT NULL").groupBy("md5").agg(F.min_by(F.struct("id", "upi", "len", "seq_short", "seq_long"), sequence_of()).alias("_row"))
    return first.select("_row.*", "md5"), filled.drop("_new", "id")


XREF = ["dbid", "ac", "upi", "version", "version_i", "created", "last", "deleted", "taxid"]


def load_xref(xref: DataFrame, staged: DataFrame, release: int, previous: int | None) -> DataFrame:
    """The cross-references after a full release of the databases that staged has.

    xref: XREF; staged: dbid, ac, upi, version, taxid, each (dbid, ac, upi) once.
    Retired rows stay. An active row that is staged with the same version goes on
    (last := release); one staged with another version is retired and comes back with its
    version_i; one that isn't staged is retired. Other staged rows are new versions:
    1 without a history; the last version_i if that was the same upi and nothing is
    active; otherwise one more. Rows of other databases don't change.
    """
    return _load_xref(xref, staged, staged.select("dbid").distinct().select("dbid", F.lit(release).alias("_release"), F.lit(previous).cast("int").alias("_previous")))


def _load_xref(xref: DataFrame, staged: DataFrame, dbs: DataFrame) -> DataFrame:
    """load_xref for databases with releases of their own. dbs: dbid, _release, _previous, one row a database."""
    release = F.col("_release")
    mine, others = xref.join(dbs, "dbid"), xref.join(dbs, "dbid", "left_anti")
    old, active = mine.where("deleted = 'Y'"), mine.where("deleted = 'N'")
    s = staged.join(dbs, "dbid").select("dbid", "ac", "upi", "_release", F.col("version").alias("_version"), F.col("taxid").alias("_taxid"), F.lit(True).alias("_hit"))
    matched = active.join(s.drop("_release"), ["dbid", "ac", "upi"], "left")
    goes_on = F.col("_hit") & (F.col("last") < release) & F.col("version").eqNullSafe(F.col("_version"))
    goes_on = F.coalesce(goes_on, F.lit(False))
    retired_at = F.coalesce(F.col("_previous"), F.col("last"))
    kept = matched.select("dbid", "ac", "upi", "version", "version_i", "created", F.when(goes_on, release).otherwise(retired_at).alias("last"), F.when(goes_on, "N").otherwise("Y").alias("deleted"), "taxid")
    fresh = dict(created=release, last=release, deleted=F.lit("N"))
    again = matched.where(F.coalesce("_hit", F.lit(False)) & ~goes_on).select("dbid", "ac", "upi", F.col("_version").alias("version"), "version_i", fresh["created"].alias("created"), fresh["last"].alias("last"), fresh["deleted"].alias("deleted"), F.col("_taxid").alias("taxid"))
    history = mine.groupBy("dbid", "ac").agg(F.max("version_i").alias("_max"), F.max_by("upi", F.struct("version_i", "created", "last", "upi")).alias("_last_upi"), F.bool_or(F.col("deleted") == "N").alias("_active"))
    new = s.join(active.select("dbid", "ac", "upi"), ["dbid", "ac", "upi"], "left_anti").join(history, ["dbid", "ac"], "left")
    version_i = F.when(F.col("_max").isNull(), 1).when(~F.col("_active") & (F.col("_last_upi") == F.col("upi")), F.col("_max")).otherwise(F.col("_max") + 1)
    added = new.select("dbid", "ac", "upi", F.col("_version").alias("version"), version_i.alias("version_i"), fresh["created"].alias("created"), fresh["last"].alias("last"), fresh["deleted"].alias("deleted"), F.col("_taxid").alias("taxid"))
    return reduce(DataFrame.unionByName, [df.select(*XREF) for df in (others, old, kept, again, added)])


def load_xref_incremental(xref: DataFrame, staged: DataFrame, release: int) -> DataFrame:
    """As load_xref, but active rows that aren't staged stay active."""
    full = load_xref(xref, staged, release, None)
    gone = xref.where("deleted = 'N'").join(staged.select("dbid").distinct(), "dbid", "left_semi").join(staged.select("dbid", "ac"), ["dbid", "ac"], "left_anti")
    keys = ["dbid", "ac", "upi", "version_i", "created"]
    return full.join(gone.select(*keys), keys, "left_anti").unionByName(gone.select(*XREF))


def release_stats(xref: DataFrame, release: int) -> DataFrame:
    """dbid, created, retired, kept, with_predecessor: rows of a release, in one aggregation."""
    first = xref.groupBy("dbid", "ac").agg(F.min("created").alias("_first"), F.count_if((F.col("created") == release) & (F.col("deleted") == "N")).alias("_new"), F.count_if((F.col("deleted") == "Y") & (F.col("last") == release - 1)).alias("_gone"), F.count_if((F.col("deleted") == "N") & (F.col("created") < release)).alias("_kept"))
    return first.groupBy("dbid").agg(F.sum("_new").alias("created"), F.sum("_gone").alias("retired"), F.sum("_kept").alias("kept"), F.sum(F.when(F.col("_first") < release, F.col("_new")).otherwise(0)).alias("with_predecessor"))


def database_stats(df: DataFrame, database: str, length: str, taxid: str) -> DataFrame:
    return df.groupBy(database).agg(F.count("*").alias("n"), F.min(length).alias("shortest"), F.max(length).alias("longest"), F.sum(length).alias("total"), F.round(F.avg(length), 4).alias("mean"), F.count_distinct(taxid).alias("langs"))


def lineage_sizes(df: DataFrame, column: str = "lineage", separator: str = "; ") -> DataFrame:
    """path, depth, size: how many distinct lineages start with each path."""
    parts = F.split(F.col(column), separator)
    paths = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(F.array_join(F.slice(parts, F.lit(1), k), separator).alias("path"), k.alias("depth")))
    return df.select(column).distinct().select(F.inline(paths)).groupBy("path", "depth").agg(F.count("*").alias("size"))


def lineage_tree(sizes: list[tuple[str, int, int]], separator: str = "; ") -> dict:
    """The nested tree of lineage_sizes' rows, for drawing."""
    root: dict = {"name": "root", "children": []}
    at = {"": root}
    for path, _, size in sorted(sizes, key=lambda r: (r[1], r[0])):
        parent, _, name = path.rpartition(separator)
        node = {"name": name, "size": size, "children": []}
        at[path] = node
        at[parent]["children"].append(node)
    return root


def release_lookup(releases: DataFrame) -> DataFrame:
    """releases (id, dbid, status) with the previous and next id of the database, and whether it is the latest or the current loaded one."""
    w = Window.partitionBy("dbid").orderBy("id")
    latest = F.max("id").over(Window.partitionBy("dbid"))
    current = F.max(F.when(F.col("status") == "D", F.col("id"))).over(Window.partitionBy("dbid"))
    return releases.select("*", F.lag("id").over(w).alias("previous"), F.lead("id").over(w).alias("next"), (F.col("id") == latest).alias("is_latest"), F.col("id").eqNullSafe(current).alias("is_current"))


def expunge(xref: DataFrame, dbid: int, release: int, last: int, previous: int | None) -> DataFrame:
    """The cross-references as if a database's release had not been: its rows go, and rows that it retired or kept return.

    last: the database's latest release. Only the latest can be undone in rows of others.
    """
    mine = F.col("dbid") == dbid
    left = xref.where(~(mine & (F.col("created") == release)))
    if release != last or previous is None:
        return left
    was_kept = mine & (F.col("deleted") == "N") & (F.col("last") == release)
    was_retired = mine & (F.col("deleted") == "Y") & (F.col("last") == previous)
    return left.withColumns({"last": F.when(was_kept, F.lit(previous)).otherwise(F.col("last")), "deleted": F.when(was_retired, F.lit("N")).otherwise(F.col("deleted"))})


def healthchecks(rna: DataFrame, xref: DataFrame, staged: DataFrame, accessions: DataFrame, references: DataFrame) -> DataFrame:
    """(check_name, bad, ok), one row a check."""
    duplicated = lambda df, *keys: df.groupBy(*keys).count().where("count > 1")
    checks = {
        "unique upi": duplicated(rna, "upi"),
        "unique md5": duplicated(rna, "md5"),
        "negative taxid": xref.where("taxid < 0"),
        "unique accession in staging": duplicated(staged, "dbid", "ac", "upi"),
        "unique active xref": duplicated(xref.where("deleted = 'N'"), "dbid", "ac", "upi"),
        "rna without xref": rna.join(xref.select("upi"), "upi", "left_anti"),
        "xref without rna": xref.join(rna.select("upi"), "upi", "left_anti"),
        "accession without reference": accessions.join(references.select("ac"), "ac", "left_anti"),
        "null ids": rna.where("upi IS NULL OR id IS NULL"),
    }
    rows = [df.agg(F.count("*").alias("bad")).select(F.lit(name).alias("check_name"), "bad", (F.col("bad") == 0).alias("ok")) for name, df in checks.items()]
    return reduce(DataFrame.unionByName, rows)


def release_changes(before: DataFrame, after: DataFrame, limit: float = 0.3) -> DataFrame:
    """dbid, n_before, n_after, change, ok: databases that shrink or grow by more than the limit aren't ok; new or lost ones are listed."""
    a, b = before.groupBy("dbid").agg(F.count("*").alias("n_before")), after.groupBy("dbid").agg(F.count("*").alias("n_after"))
    joined = a.join(b, "dbid", "full").select("dbid", F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"))
    change = F.round(F.try_divide(F.col("n_after") - F.col("n_before"), F.col("n_before")), 6)
    return joined.withColumn("change", change).withColumn("ok", F.coalesce(F.abs("change") <= limit, F.lit(False)))


def active_upi(xref: DataFrame, releases: DataFrame) -> DataFrame:
    """dbid, n: distinct upis whose last release is the database's latest full one or later."""
    latest = releases.where("release_type = 'F'").groupBy("dbid").agg(F.max("id").alias("_latest"))
    return xref.join(latest, "dbid").where("last >= _latest").groupBy("dbid").agg(F.count_distinct("upi").alias("n"))


def run_releases(xref: DataFrame, staged: DataFrame, first: int) -> tuple[DataFrame, DataFrame]:
    """All staged databases, one after another: (xref, releases). Databases get consecutive ids in order of dbid.

    One plan for all databases: the release and the one before it are columns of a table with a row for each.
    """
    numbered = staged.select("dbid").distinct().select("dbid", (F.row_number().over(Window.orderBy("dbid")) + (first - 1)).cast("int").alias("_release"))
    previous = xref.groupBy("dbid").agg(F.max("last").cast("int").alias("_previous"))
    dbs = numbered.join(previous, "dbid", "left").select("dbid", "_release", "_previous")
    releases = numbered.select(F.col("_release").alias("id"), "dbid", F.lit("F").alias("release_type"), F.lit("D").alias("status"))
    return _load_xref(xref, staged, dbs), releases
