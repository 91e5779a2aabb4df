"""Operators and plans that SQL does not cover, on hand-made rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from strandforge import catalog
from strandforge.functions import identifiers, sequences
from strandforge.operators import ranges
from strandforge.operators import relational as R
from strandforge.plans import genes, precompute, release
from strandforge.sources import entries, readers
from strandforge.streaming import events

XREF = "dbid int, ac string, upi string, version int, version_i int, created int, last int, deleted string, taxid long"
STAGED = "dbid int, ac string, upi string, version int, taxid long"


def test_xref_scenarios(spark):
    """Prior row and staged row of one accession each, and what must come out: (upi, version_i, created, last, deleted)."""
    scenarios = {
        "same": (("U1", 1, 1, "N"), ("U1", 1), [("U1", 1, 1, 2, "N")]),
        "new version": (("U1", 1, 1, "N"), ("U1", 2), [("U1", 1, 1, 1, "Y"), ("U1", 1, 2, 2, "N")]),
        "new upi": (("U1", 1, 1, "N"), ("U2", 1), [("U1", 1, 1, 1, "Y"), ("U2", 2, 2, 2, "N")]),
        "gone": (("U1", 1, 1, "N"), None, [("U1", 1, 1, 1, "Y")]),
        "first": (None, ("U1", 1), [("U1", 1, 2, 2, "N")]),
        "back": (("U1", 1, 3, "Y"), ("U1", 1), [("U1", 3, 1, 1, "Y"), ("U1", 3, 2, 2, "N")]),
        "back as other": (("U1", 1, 3, "Y"), ("U2", 1), [("U1", 3, 1, 1, "Y"), ("U2", 4, 2, 2, "N")]),
        "null version": (("U1", None, 1, "N"), ("U1", None), [("U1", 1, 1, 2, "N")]),
    }
    old = [(1, ac, p[0], p[1], p[2], 1, 1, p[3], 9606) for ac, (p, _, _) in scenarios.items() if p]
    new = [(1, ac, s[0], s[1], 9606) for ac, (_, s, _) in scenarios.items() if s] + []
    other = [(2, "else", "U9", 1, 1, 1, 1, "N", 1)]
    out = release.load_xref(spark.createDataFrame(old + other, XREF), spark.createDataFrame(new, STAGED), 2, 1).collect()
    for ac, (_, _, want) in scenarios.items():
        assert sorted((r.upi, r.version_i, r.created, r.last, r.deleted) for r in out if r.ac == ac) == sorted(want), ac
    assert [r for r in out if r.dbid == 2 and (r.last, r.deleted) == (1, "N")]


def test_md5_collisions_stay_out(spark):
    schema = "md5 string, len long, seq_short string, seq_long string"
    rna = spark.createDataFrame([(5, "URS0000000005", "m1", 3, "AAA", None)], "id long, upi string, md5 string, len long, seq_short string, seq_long string")
    staged = spark.createDataFrame([("m1", 3, "AAA", None), ("m2", 3, "CCC", None), ("m3", 3, "GGG", None), ("m3", 3, "TTT", None), ("m1", 3, "AAA", None)], schema)
    new, filled = release.load_sequences(rna, staged)
    assert [(r.id, r.upi) for r in new.collect()] == [(6, "URS0000000006")]
    assert {r.md5: r.upi for r in filled.collect()} == {"m1": "URS0000000005", "m2": "URS0000000006", "m3": None}


def test_newer_known_release_raises(spark):
    new, old = spark.createDataFrame([("a", 3)], "upi string, last int"), spark.createDataFrame([("a", 4)], "upi string, last_release int")
    with pytest.raises(Exception, match="not loaded"):
        precompute.outdated(new, old).collect()


def test_group_criteria(spark):
    base = spark.createDataFrame([(1,), (2,)], "id int")
    two = spark.createDataFrame([(1, "a"), (1, "b")], "id int, x string")
    assert [len(r.c) for r in R.group_children(base, two, "id", "c").orderBy("id").collect()] == [2, 0]
    for criterion in ("at_least_one", "exactly_one", "zero_or_one"):
        with pytest.raises(Exception, match="broken"):
            R.group_children(base, two, "id", "c", criterion).collect()


def test_update_from_refuses_two_matches(spark):
    t, s = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(Exception, match="several"):
        R.update_from(t, s, "k", v=F.col("s_v")).collect()


@pytest.mark.parametrize("seed", range(3))
def test_near_pairs_and_overlaps_at_random(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice("ab"), p := rng.randint(-3000, 3000), p + rng.randint(1, 400)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, k string, start long, stop long")
    got = {(r.id_a, r.id_b) for r in ranges.near_pairs(df, ["k"], "start", "id", 250).collect()}
    assert got == {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and abs(a[2] - b[2]) <= 250}
    hits = [(r.l_id, r.r_id) for r in ranges.overlap_join(df, df, ["k"], 100).collect()]
    assert sorted(hits) == sorted((a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and a[2] < b[3] and b[2] < a[3])


def test_greedy_matches_use_each_once(spark):
    old = spark.createDataFrame([("o1", "c", 100, 200), ("o2", "c", 101, 201)], "id string, k string, start long, stop long")
    new = spark.createDataFrame([("n1", "c", 100, 201), ("n2", "c", 102, 201), ("n3", "c", 103, 200)], "id string, k string, start long, stop long")
    assert {(r.new_id, r.old_id) for r in ranges.greedy_matches(old, new, ["k"], 10, 0.9).collect()} == {("n1", "o1"), ("n2", "o2")}


def test_type_paths_merge_in_order(spark):
    rows = [("a", 1, ["ncRNA"], "generic"), ("a", 2, ["ncRNA", "rRNA"], "mod"), ("a", 3, ["ncRNA", "tRNA"], "rfam_hit"), ("b", 1, ["ncRNA", "lnc_RNA"], "generic")]
    merged = precompute.merge_type_paths(spark.createDataFrame(rows, "urs_taxid string, place int, path array<string>, source string"))
    assert sorted((r.urs_taxid, *r.path) for r in merged.collect()) == [("a", "ncRNA", "rRNA"), ("a", "ncRNA", "tRNA"), ("b", "ncRNA", "lnc_RNA")]
    assert {r.urs_taxid: r.so_type for r in precompute.decide_type(merged).collect()} == {"a": "rRNA", "b": "lnc_RNA"}


def test_communities(spark):
    edges = [("g", "1", a, b, 1.0) for x in ("abc", "xyz") for a in x for b in x if a < b] + [("g", "1", "c", "x", 0.1)]
    out = genes.communities(spark.createDataFrame(edges, "assembly_id string, chromosome string, a string, b string, weight double"), ["assembly_id", "chromosome"]).collect()
    assert {r.member: r.community for r in out} == {**dict.fromkeys("abc", "a"), **dict.fromkeys("xyz", "x")}


def test_identifiers(spark):
    df = spark.createDataFrame([(12601134, "IHATEMATH", "some key")], "n long, s string, k string")
    r = df.select(identifiers.urs(F.col("n")).alias("u"), identifiers.crc64("s").alias("c"), identifiers.sha_number(F.col("k")).alias("h"), sequences.balanced(F.lit("((..))")).alias("b")).first()
    assert r.u == "URS0000C0472E" and r.c == "E3DCADD69B01ADD1" and r.b
    assert r.h == str(int(hashlib.sha256(b"some key").hexdigest(), 16) % 10**11).zfill(11)


def test_readers(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">x one two\nACG\nUU\n>y\nGG\n")
    assert [tuple(r) for r in readers.fasta(spark, str(tmp_path / "a.fa")).collect()] == [("x", "one two", "ACGUU"), ("y", "", "GG")]
    (tmp_path / "a.gff").write_text("##gff\nc1\ts\texon\t5\t9\t.\t-\t.\tID=e2;Parent=t1\nc1\ts\texon\t1\t3\t.\t-\t.\tID=e1;Parent=t1\n")
    t = readers.gff_transcripts(readers.gff3(spark, str(tmp_path / "a.gff"))).first()
    assert (t.transcript, t.strand, [tuple(e) for e in t.exons]) == ("t1", -1, [(1, 3), (5, 9)])
    (tmp_path / "a.embl").write_text('ID   AB1; SV 2; linear;\nAC   AB1;\nDE   A tRNA\nOS   Mus musculus\nFT   source          1..4\nFT                   /db_xref="taxon:10090"\nFT   tRNA            1..4\nFT                   /product="tRNA-Ala"\nSQ   Sequence 4 BP;\n     acgu                                                              4\n//\n')
    e = entries.from_flat(readers.embl(spark, str(tmp_path / "a.embl")), "ENA").first()
    assert (e.primary_id, e.ncbi_tax_id, e.sequence, e.so_type, e.description, e.seq_version) == ("AB1", 10090, "ACGT", "SO:0000253", "tRNA-Ala", "2")
    (tmp_path / "a.json").write_text('{"data": [{"primaryId": "p", "taxonId": "NCBITaxon:9606", "sequence": "ACGUACGUAC", "soTermId": "SO:1"}]}')
    g = entries.valid(entries.generic_json(spark, str(tmp_path / "a.json"), "FLYBASE")).first()
    assert (g.accession, g.ncbi_tax_id, g.sequence) == ("p", 9606, "ACGTACGTAC")
    (tmp_path / "a.obo").write_text("format\n\n[Term]\nid: SO:1\nname: a\n\n[Term]\nid: SO:2\nname: b\nis_a: SO:1 ! a\n")
    terms, edges = readers.obo(spark, str(tmp_path / "a.obo"))
    assert terms.count() == 2 and [tuple(r) for r in edges.collect()] == [("SO:2", "SO:1")]
    (tmp_path / "a.tcode").write_text("# Sequence: U1 from: 1 to: 9\n  1 5 + 0.9 Coding\n  2 6 + 0.7 No\n# Sequence: U2 from: 1 to: 9\n  1 5 + 0.5 No\n")
    assert {r.urs: (round(r["mean"], 3), r.sd > 0) for r in readers.tcode(spark, str(tmp_path / "a.tcode")).collect()} == {"U1": (0.8, True), "U2": (0.5, False)}


def test_partition_exchange(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), XREF)
    root = str(tmp_path)
    catalog.write(rows((1, "a", "U", 1, 1, 1, 1, "N", 1), (2, "b", "U", 1, 1, 1, 1, "N", 1)), root, "xref", only_touched=False)
    catalog.write(rows((1, "c", "U", 1, 1, 1, 1, "N", 1)), root, "xref")
    assert sorted(r.ac for r in catalog.read(spark, root, "xref").collect()) == ["b", "c"]


def test_streaming_windows(spark, small, tmp_path):
    spark.read.parquet(f"{small}/events.parquet").repartition(4).write.parquet(str(tmp_path / "in"))
    counts = events.windowed_counts(events.read_events(spark, str(tmp_path / "in"), 100), "1 day", "100000 days")
    query = counts.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.sql("SELECT sum(n) FROM windows").first()[0] == spark.read.parquet(f"{small}/events.parquet").count()


def brute_greedy(old, new, distance, overlap):
    """old, new: (key, id, start, stop)."""
    taken, out = set(), set()
    for k, n, s, e in sorted(new, key=lambda r: (r[2], r[3], r[1])):
        for k2, o, s2, e2 in sorted((r for r in old if r[0] == k and abs(r[2] - s) < distance), key=lambda r: (r[2], r[3], r[1])):
            if o not in taken and abs(e - e2) < distance and min(e, e2) - max(s, s2) > overlap * (max(e, e2) - min(s, s2)):
                taken.add(o)
                out.add((n, o))
                break
    return out


def test_greedy_matches_against_brute_force(spark):
    import random

    rng = random.Random(5)
    for width in (6, 400):
        make = lambda p: [(rng.choice("ab"), f"{p}{i}", s := rng.randrange(width), s + rng.randrange(1, 40)) for i in range(150)]
        old, new = make("o"), make("n")
        frame = lambda rows: spark.createDataFrame([*rows, (None, "x", 1, 9), ("a", "y", None, 9), ("a", "z", 1, None)], "k string, id string, start long, stop long")
        assert {(r.new_id, r.old_id) for r in ranges.greedy_matches(frame(old), frame(new), ["k"], 30, 0.5).collect()} == brute_greedy(old, new, 30, 0.5)


def test_join_window_near_iter_takes_all_line_items(spark):
    import datetime

    import strandforge.queries as q

    folder = "/root/testdata/sf0.001"
    sides = {"F": [], "O": []}
    for r in spark.read.parquet(f"{folder}/lineitem.parquet").collect():
        d = (r.l_shipdate.date() - datetime.date(1970, 1, 1)).days
        sides[r.l_linestatus].append((r.l_returnflag, f"{r.l_orderkey}-{r.l_linenumber}-{d}-{int(r.l_quantity)}", d, d + int(r.l_quantity)))
    got = [(r.new_id, r.old_id) for r in q.QUERIES["join_window_near_iter"](spark, folder).collect()]
    want = brute_greedy(sides["F"], sides["O"], 30, 0.5)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_op_description_takes_whole_texts(spark, tmp_path):
    import math
    import re
    from collections import Counter

    import strandforge.queries as q

    def entropy(s):
        kept = re.sub("[^a-z0-9]", "", s.lower())
        return -sum(k / len(kept) * math.log2(k / len(kept)) for k in Counter(kept).values()) if kept else 0.0

    def best(rows):
        place = {"de": 1, "fr": 2, "en": 3}
        found = {}
        for source, lang, s in rows:
            if s is not None:
                score = (place.get(lang, 4), -round(entropy(s), 3), [ord(c) for c in s] + [0x110000] if s else [])
                found[source] = min(found.get(source, (score, s)), (score, s))
        return {k: v[1] for k, v in found.items()}

    same = "equal for more than forty characters at first "
    rows = [("a", "de", same + "aaaa"), ("a", "de", same + "xyz 0123456789"), ("a", "en", "better 0123456789 abcdefghijklmnopqrstuvwxyz"), ("b", "fr", same * 3 + "!b"), ("b", "fr", same * 3 + "!a"), ("b", "xx", None), ("c", "en", "ab"), ("c", "en", "ab..."), (None, None, "one"), ("d", "de", ""), ("d", "de", "?")]
    spark.createDataFrame(rows, "source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for folder in (str(tmp_path), "/root/testdata/sf0.001"):
        docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("source", "lang", "text").collect()]
        assert {r.urs_taxid: r.description for r in q.QUERIES["op_description"](spark, folder).collect()} == best(docs)


def test_op_gene_communities_do_not_depend_on_where_ids_lie(spark, tmp_path):
    import random

    import strandforge.queries as q

    def found(first):
        # a chain of orders; what the features read moves with the id by a multiple of 6
        folder = f"{tmp_path}/{first}"
        rng = random.Random(3)
        lines = [(first + k, n, float(rng.randrange(1, 50))) for k in range(90) for n in rng.sample(range(1, 8), 3)]
        spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")
        spark.createDataFrame([(r,) for r in range(5)], "r_regionkey int").write.parquet(f"{folder}/region.parquet")
        rows = [(r.chromosome, r.member - first, r.community - first) for r in q.QUERIES["op_gene_communities"](spark, folder).collect()]
        assert len({m for _, m, _ in rows}) == len(rows)  # each in one community
        return sorted(rows)

    far, border = found(96), found(96 + 6 * 810)  # the second from 4,956 to 5,045
    assert far and far == border and {c for c, _, _ in border} == {"1"}


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_ids_and_chunks_lose_no_wide_rows(spark, partitions):
    """Branches of one plan whose exchanges differ in width are coalesced unlike each other."""
    n = 60_000
    wide = spark.range(n).select(F.xxhash64("id").alias("k"), F.lit(3).cast("long").alias("size"), *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 256).alias(f"w{i}") for i in range(6)]).repartition(partitions)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "30")
        ids = R.dense_ids(wide, "k", "id", 5).agg(F.count("*"), F.count_distinct("id"), F.min("id"), F.max("id")).first()
        assert tuple(ids) == (n, n, 5, n + 4)
        chunks = R.size_chunks(wide, "k", "size", 1000).groupBy("chunk").agg(F.sum("size").alias("s")).orderBy("chunk").collect()
        assert sum(r.s for r in chunks) == 3 * n and [r.chunk for r in chunks] == list(range(180)) and all(990 <= r.s <= 1010 for r in chunks)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_ids_of_rows_alike_nulls_and_no_rows(spark):
    rows = spark.createDataFrame([(None, "x"), (None, "x"), ("b", "y"), ("b", "y"), ("a", "z")], "k string, v string")
    got = sorted((r.id, r.k) for r in R.dense_ids(rows, "k", "id").collect())
    assert got == [(1, None), (2, None), (3, "a"), (4, "b"), (5, "b")]
    assert R.dense_ids(rows.limit(0), "k", "id").count() == 0


def test_releases_of_many_databases_in_one_plan(spark):
    staged = spark.createDataFrame([(d, f"a{d}", f"u{d}", 1, 9) for d in range(60)], "dbid int, ac string, upi string, version int, taxid int")
    xref = spark.createDataFrame([(d, f"a{d}", "old", 1, 1, 1, 1, "N", 9) for d in range(0, 60, 2)] + [(99, "a", "u", 1, 1, 1, 1, "N", 9)], "dbid int, ac string, upi string, version int, version_i int, created int, last int, deleted string, taxid int")
    after, releases = release.run_releases(xref, staged, 10)
    assert len(after._jdf.queryExecution().analyzed().toString()) < 60_000
    assert sorted((r.id, r.dbid) for r in releases.collect()) == [(10 + d, d) for d in range(60)]
    rows = {(r.dbid, r.upi): (r.version_i, r.created, r["last"], r.deleted) for r in after.collect()}
    assert len(rows) == 60 + 30 + 1 and rows[99, "u"] == (1, 1, 1, "N")
    for d in range(60):
        assert rows[d, f"u{d}"] == (2 if d % 2 == 0 else 1, 10 + d, 10 + d, "N")
        assert d % 2 or rows[d, "old"] == (1, 1, 1, "Y")
