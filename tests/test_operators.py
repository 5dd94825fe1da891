"""Invariants and small cases of the operators that have no SQL."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lymphlake.catalog import QUERIES
from lymphlake.operators import align, barcodes, batch_align, cells, clones, graph, hits, hsp, profiles, rearrange, rules
from lymphlake.plans.views import view
from lymphlake.sources import airr, sequences


def hamming_share(a, b):
    return sum(x == y for x, y in zip(a, b, strict=True)) / max(1, len(a))


def test_clone_clusters_are_greedy(spark, sf):
    t = view(spark, sf, "rearrangements")
    got = clones.clone_clusters(t).toPandas()
    info = t.toPandas().set_index("sequence_id")
    assert len(got) == len(info)
    by = {}
    for s, j, c in zip(got.sequence_id, got.junction, got.centroid, strict=True):
        centre = info.loc[c]
        assert hamming_share(j, centre.junction) >= 0.9 - 1e-9 and len(j) == len(centre.junction)
        key = (info.loc[s].v_call.split("*")[0], info.loc[s].j_call.split("*")[0], len(j))
        by.setdefault(key, set()).add(centre.junction)
    for centres in by.values():
        centres = sorted(centres)
        for i, a in enumerate(centres):
            for b in centres[i + 1 :]:
                assert hamming_share(a, b) < 0.9


def test_results_do_not_depend_on_partitions(spark, sf):
    names = ("clone_clustering", "umi_consensus", "redundancy_collapse")
    first = {n: sorted(map(str, QUERIES[n](spark, sf).collect())) for n in names}
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for n in names:
            assert sorted(map(str, QUERIES[n](spark, sf).collect())) == first[n]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_greedy_with_gaps():
    block = [("a", "ACGTACGTAC"), ("b", "ACGTACGTA"), ("c", "TTTTTTTTTT")]
    assert clones.greedy_centroids(block, 0.9, band=1) == ["a", "a", "c"]
    assert clones.greedy_centroids(block, 0.9) == ["a", "b", "c"]
    assert clones.greedy_centroids([("x", ""), ("y", "")], 0.9) == ["x", "x"]


def test_alignment():
    assert align.align_pair("ACGT", "ACGT") == ("ACGT", "ACGT")
    a, b = align.align_pair("ACGGTACGTT", "ACGTACGTT")
    assert a.replace("-", "") == "ACGGTACGTT" and b.replace("-", "") == "ACGTACGTT" and len(a) == len(b) == 10
    a, b = align.align_pair("CGTA", "TTCGTATT")
    assert (a, b) == ("--CGTA--", "TTCGTATT")
    assert align.banded_identity("ACGTACGT", "ACGACGT", 1) == pytest.approx(1.0)


def _path_score(a, b, gap_open, gap_extend):
    """Score of an alignment with free gaps at the ends."""
    both = [i for i in range(len(a)) if a[i] != "-" and b[i] != "-"]
    if not both:
        return 0
    total, side = 0, None
    for x, y in zip(a[both[0] : both[-1] + 1], b[both[0] : both[-1] + 1], strict=True):
        now = "a" if x == "-" else "b" if y == "-" else None
        total -= (gap_open if now != side else 0) + gap_extend if now else (-1 if x == y else 1)
        side = now
    return total


def _best_score(a, b, gap_open, gap_extend):
    """The same, over all alignments, by plain recursion."""
    from functools import cache

    @cache
    def best(i, j, side):
        if i == len(a) or j == len(b):
            return 0
        pair = best(i + 1, j + 1, None) + (1 if a[i] == b[j] else -1)
        cost = lambda s: (gap_open if s != side else 0) + gap_extend
        return max(pair, best(i + 1, j, "b") - cost("b"), best(i, j + 1, "a") - cost("a"))

    return max([0, *(best(i, 0, None) for i in range(len(a))), *(best(0, j, None) for j in range(len(b)))])


@pytest.mark.parametrize("costs", [(0, 2), (5, 2), (1, 1)])
def test_alignment_is_the_best_one(costs):
    rng = np.random.default_rng(7)
    for _ in range(60):
        x = "".join(rng.choice(list("ACGT"), rng.integers(1, 14)))
        y = x[: rng.integers(0, 5)] + "".join(rng.choice(list("ACGT"), rng.integers(1, 5))) + x[rng.integers(0, len(x)) :]
        a, b = align.align_pair(x, y, *costs)
        assert len(a) == len(b) and a.replace("-", "") == x and b.replace("-", "") == y
        assert _path_score(a, b, *costs) == _best_score(x, y, *costs)


def test_one_long_gap_costs_less_than_two():
    left, right = "ACGTTGCAACGGTCATGCCA", "GGATCCTTAGACCAGTATTC"
    a, b = align.align_pair(left + "TTTTT" + right, left + right, 5, 2)
    assert b.strip("-").count("-") == 5 and "-----" in b and a == left + "TTTTT" + right


def test_pair_identity_of_unequal_lengths(spark):
    from lymphlake.operators import longitudinal

    rows = [("c", "1", "ACGT"), ("c", "2", "ACGA"), ("c", "3", "ACGTT"), ("c", "4", "ACGT"), ("d", "5", "ACGT"), ("c", "6", "")]
    members = spark.createDataFrame(rows, "cluster string, id string, seq string")
    got = {(r["a"], r["b"]): r["identity"] for r in longitudinal.pair_identity(members).collect()}
    assert got == {("1", "2"): 0.75, ("1", "3"): 0.8, ("2", "3"): pytest.approx(0.6), ("1", "6"): 0.0, ("2", "6"): 0.0, ("3", "6"): 0.0}


def test_too_many_natives(spark):
    seqs = spark.createDataFrame([(str(i), "ACGT" * 5) for i in range(4)], "id string, seq string")
    with pytest.raises(ValueError, match="known antibodies"):
        align.sieve(seqs, seqs, ("g", "ACGT"), most_natives=3)


def test_neighbour_joining_finds_the_clade():
    rng = np.random.default_rng(1)
    base, other = ("".join(rng.choice(list("ACGT"), 60)) for _ in range(2))
    kin = [base[:i] + "A" + base[i + 1 :] for i in (5, 25, 45)]
    far = [other[:i] + "C" + other[i + 1 :] for i in (5, 25, 45)]
    names = ["k0", "k1", "f0", "f1", "f2", "n0", "root"]
    found = align.near_antibodies(names, [*kin[:2], *far, kin[2], "".join(rng.choice(list("ACGT"), 60))], {"n0"}, "root")
    assert "n0" in found and not found & {"f0", "f1", "f2"}


def test_sieve_shrinks(spark):
    rng = np.random.default_rng(2)
    base, other = ("".join(rng.choice(list("ACGT"), 80)) for _ in range(2))

    def near(s, i):
        return s[:i] + "ACGT"[i % 4] + s[i + 1 :]

    reads = spark.createDataFrame([(f"k{i}", near(base, i)) for i in range(20)] + [(f"f{i}", near(other, i)) for i in range(20)], "id string, seq string")
    natives = spark.createDataFrame([("n1", near(base, 70)), ("n2", near(base, 75))], "id string, seq string")
    left = {r["id"] for r in align.sieve(reads, natives, ("germ", "".join(rng.choice(list("ACGT"), 80))), batch=50).collect()}
    assert left and all(x.startswith("k") for x in left)


def test_components_and_cliques(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e"), ("c", "z")], "a string, b string")
    assert {r["node"]: r["component"] for r in graph.components(edges).collect()} == {"a": "a", "b": "a", "c": "a", "z": "a", "d": "d", "e": "d"}
    assert graph.components(edges.limit(0)).count() == 0
    near = {1: {2, 3}, 2: {1, 3}, 3: {1, 2, 4}, 4: {3}}
    assert sorted(map(sorted, cells.maximal_cliques(near))) == [[1, 2, 3], [3, 4]]


def test_joint_clones(spark):
    rows = [("c1", "H1"), ("c1", "L1"), ("c2", "H1"), ("c2", "L1"), ("c3", "H1"), ("c4", "H9"), ("c5", "H1"), ("c5", "L2")]
    got = {r["cell_id"]: r["clone"] for r in cells.joint_clones(spark.createDataFrame(rows, "cell_id string, cluster string")).collect()}
    assert got == {"c1": "H1+L1", "c2": "H1+L1", "c3": None, "c4": "H9", "c5": "H1+L2"}


def test_redundant_chains(spark):
    rows = [("c", "IGH", "a", "IGHV1-1*01", "IGHJ1*01", "A" * 40, "good", 5), ("c", "IGH", "b", "IGHV1-1*02", "IGHJ1*01", "A" * 39 + "C", "stop", 3), ("c", "IGH", "d", "IGHV1-1*02", "IGHJ1*01", "C" * 40, "good", 2)]
    t = spark.createDataFrame(rows, "cell_id string, locus string, sequence_id string, v_call string, j_call string, junction string, status string, duplicate_count long")
    got = {r["sequence_id"]: (r["duplicate_count"], r["n_merged"]) for r in cells.collapse_redundant(t).collect()}
    assert got == {"a": (8, 2), "d": (2, 1)}


def test_copies_of_a_chain_are_summed_before_the_cells_meet(spark):
    """No cell is gathered, copies of any number follow their chain, and one without a count adds nothing."""
    n = F.col("id")
    junction = F.concat(F.repeat(F.lit("A"), 39), F.substr(F.lit("ACGT"), (1 + n % 4).cast("int"), F.lit(1)))
    t = spark.range(4_000).select(F.lit("c").alias("cell_id"), F.lit("IGH").alias("locus"), F.format_string("s%05d", n).alias("sequence_id"), F.lit("IGHV1-1*01").alias("v_call"), F.lit("IGHJ1*01").alias("j_call"), F.when(n == 7, F.lit("C" * 40)).when(n > 7, junction).otherwise(F.repeat(F.lit("A"), 40)).alias("junction"), F.lit("good").alias("status"), F.when(n == 3, None).when(n == 2, 9).otherwise(1).cast("long").alias("duplicate_count"))
    kept = cells.collapse_redundant(t)
    assert "collect_list" not in kept._jdf.queryExecution().toString()
    assert sum(r["duplicate_count"] for r in kept.collect()) == 4_000 - 1 + 8
    assert {r["n_merged"] for r in kept.collect()} == {1, 3_999}


def test_umi_consensus(spark):
    rows = [("c", "u", "ACGTACGTACGTACGTACGT")] * 3 + [("c", "u", "ACGTACGTACGTACGTACGA"), ("c", "u", "TTTTTTTTTTTTTTTTTTTT"), ("c", "w", "ACGT")]
    got = barcodes.largest_cluster(spark.createDataFrame(rows, "cell string, umi string, seq string")).collect()
    assert [(r["n"], r["multi"], r["size"], r["consensus"]) for r in got] == [(5, 1, 4, "ACGTACGTACGTACGTACGT")]
    single = barcodes.largest_cluster(spark.createDataFrame(rows[-1:], "cell string, umi string, seq string"), least=1).first()
    assert (single["size"], single["consensus"]) == (1, "ACGT")


def test_cell_consensus_counts_umis(spark):
    rows = [("c", "u1", 5, "ACGTACGTAC"), ("c", "u2", 4, "ACGTACGTAC"), ("c", "u3", 9, "TTTTTTTTTT")]
    got = barcodes.cell_consensus(spark.createDataFrame(rows, "cell string, umi string, size long, consensus string"), least_umis=2).collect()
    assert [(r["sequence_id"], r["duplicate_count"], r["consensus_count"]) for r in got] == [("c.1", 2, 9)]


def test_fasta_and_fastq_edges(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">x one\nAC\nGT\n\n>y\n>z k=v;size=3\nA\n")
    got = {r["id"]: (r["seq"], r["description"], r["source_file"]) for r in sequences.read_fasta(spark, str(tmp_path / "a.fa")).collect()}
    assert got == {"x": ("ACGT", "x one", "a.fa"), "y": ("", "y", "a.fa"), "z": ("A", "z k=v;size=3", "a.fa")}
    (tmp_path / "q").mkdir()
    text = "".join(f"@r{i}\n{'ACGT' * 5}\n+\n{'@' * 20}\n" for i in range(500))
    (tmp_path / "q/a.fastq").write_text(text)
    for size in (37, 1000, 1 << 20):
        rows = sequences.read_fastq(spark, str(tmp_path / "q"), rangeBytes=size).collect()
        assert sorted(r["id"] for r in rows) == sorted(f"r{i}" for i in range(500))


def test_airr_requires_fields(spark, tmp_path):
    spark.createDataFrame([("a", "T")], "sequence_id string, productive string").write.csv(str(tmp_path / "t"), sep="\t", header=True)
    with pytest.raises(ValueError, match="v_call"):
        airr.read_airr(spark, str(tmp_path / "t"))
    assert airr.read_airr(spark, str(tmp_path / "t"), ("sequence_id",)).first()["productive"] is True


def test_rules_errors_and_columns(spark):
    t = spark.createDataFrame([(1, 2), (3, 2)], "a int, b int")
    assert rules.filter_rules(t, ["a,>,`b`"]).count() == 1
    with pytest.raises(ValueError, match="column"):
        rules.rule_column(t, "z,==,1")
    with pytest.raises(ValueError, match="operator"):
        rules.rule_column(t, "a,~,1")


def test_tied_calls_by_hand(spark):
    rows = [("r", "IGHV1-2*02", 50.0, 1), ("r", "IGHV1-2*01", 49.0, 2), ("r", "IGHV1-3*01", 47.0, 3), ("r", "IGHV1-3*02", 47.0, 4), ("r", "IGHV5-1*01", 40.0, 5)]
    got = hits.tied_calls(spark.createDataFrame(rows, "qid string, sid string, score double, hit_rank int")).first()
    assert got["calls"] == "IGHV1-2*02,IGHV1-3*01"


def test_library_imports_without_corpus_modules():
    import pathlib

    root = pathlib.Path(rules.__file__).parent.parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "lymphlake.llm" not in path.read_text()


def test_merge_pairs(spark):
    a = "ACGTTGCAAGCTTAGCATCG"
    pairs = spark.createDataFrame([("x", a[:15]), ("y", "A" * 15)], "id string, seq1 string").withColumn("seq2", F.reverse(F.translate(F.lit(a[5:]), "ACGT", "TGCA")))
    got = {r["id"]: r["merged"] for r in barcodes.merge_pairs(pairs, least_length=10, least_overlap=8, most_diffs=0).collect()}
    assert got == {"x": a, "y": None}
    # of bases that differ the better one stays; null mates and qualities of another length give null
    marks = spark.createDataFrame([("x", a[:14] + "T", "I" * 14 + "#", "I" * 15), ("z", a[:15], "I" * 15, "I" * 3), ("n", None, None, "I" * 15)], "id string, seq1 string, qual1 string, qual2 string").withColumn("seq2", F.reverse(F.translate(F.lit(a[5:]), "ACGT", "TGCA")))
    got = {r["id"]: (r["merged"], r["qual"]) for r in barcodes.merge_pairs(marks, least_length=10, least_overlap=8).collect()}
    assert got["z"] == got["n"] == (None, None) and got["x"][0] == a and len(got["x"][1]) == 20 and got["x"][1][5] == "J" and got["x"][1][14] < "J"


def test_running_clones_follow_the_batch(spark, sf, tmp_path):
    from lymphlake.streaming.clones import rearrangement_stream, running_clones

    t = view(spark, sf, "rearrangements")
    t.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = running_clones(rearrangement_stream(spark, str(tmp_path / "in"), t.schema))
    q = stream.writeStream.format("memory").queryName("running").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    want = {(r["v_gene"], r["j_gene"], r["junction"]): (r["clone_count"], r["abundance"]) for r in QUERIES["clone_ranking"](spark, sf).collect()}
    got = {(r["v_gene"], r["j_gene"], r["junction"]): (r["clone_count"], r["abundance"]) for r in spark.table("running").collect()}
    assert got == want


def test_germline_hits_find_the_source(spark, sf):
    g = view(spark, sf, "germline").select("allele", "seq")
    reads = g.where("allele like '%*01'").select(F.col("allele").alias("id"), F.concat(F.lit("ACGTACG"), F.substr("seq", F.lit(4))).alias("seq"))
    top = align.germline_hits(reads, g).where("hit_rank = 1").collect()
    assert len(top) == reads.count()
    for r in top:
        assert r["sid"] == r["qid"] and r["strand"] == "plus" and r["identity"] == 100.0
        assert r["qstart"] - r["sstart"] == 4 and r["qstart"] <= 8


def test_every_read_meets_one_allele(spark, sf):
    from lymphlake.catalog.sources import one_allele_each
    from lymphlake.plans.views import view

    g = view(spark, sf, "germline")
    reads = spark.range(3000).select(F.col("id").cast("string").alias("name"))
    got = one_allele_each(reads, g, "name").select("name", "allele").collect()
    assert len(got) == len({r["name"] for r in got}) == 3000 and len({r["allele"] for r in got}) == g.count()


def test_airr_derive_writes_every_row(spark, sf, monkeypatch):
    from lymphlake.catalog import QUERIES
    from lymphlake.plans.views import view
    from lymphlake.sources import airr

    seen, write = [], airr.write_airr
    monkeypatch.setattr(airr, "write_airr", lambda t, path: seen.append(t.count()) or write(t, path))
    QUERIES["airr_derive"](spark, sf).count()
    assert seen == [view(spark, sf, "rearrangements").count()]


def test_ranks_with_one_size_and_one_prefix(spark):
    from lymphlake.operators.order import ranked

    t = spark.range(5000).select(F.concat(F.lit("instrument:1:"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("id"), F.lit(1).alias("clone_count"))
    t = t.repartition(7).withColumn("centroid", F.col("id"))
    reads = {r["id"]: int(r["read_id"]) for r in sequences.numbered_reads(t).collect()}
    assert [reads[k] for k in sorted(reads)] == list(range(1, 5001))
    ids = {r["centroid"]: int(r["clone_id"]) for r in clones.numbered(t, first=3).collect()}
    assert [ids[k] for k in sorted(ids)] == list(range(3, 5003))
    assert ranked(t.limit(0), [F.asc("id")]).count() == 0
    same = ranked(spark.range(100).select(F.lit("x").alias("v")), [F.asc("v")])
    assert sorted(r["rank"] for r in same.collect()) == list(range(1, 101))


@pytest.mark.parametrize(("seed", "nodes", "size"), [(0, 12, 3), (1, 30, 4), (2, 8, 5), (3, 60, 2)])
def test_joint_clones_equal_the_cliques(spark, seed, nodes, size):
    rng = np.random.default_rng(seed)
    sets = {f"c{i}": {f"n{x}" for x in rng.integers(0, nodes, rng.integers(1, size + 1))} for i in range(60)}
    near = {}
    for own in sets.values():
        for x in own:
            near.setdefault(x, set()).update(own - {x})
    cliques = cells.maximal_cliques(near)
    want = {}
    for cell, own in sets.items():
        holding = [c for c in cliques if own <= c]
        want[cell] = "+".join(sorted(holding[0])) if len(holding) == 1 else None
    rows = [(c, x) for c, own in sets.items() for x in own]
    got = {r["cell_id"]: r["clone"] for r in cells.joint_clones(spark.createDataFrame(rows, "cell_id string, cluster string")).collect()}
    assert got == want


def test_joint_clones_of_a_wide_graph(spark):
    """More clusters in one component than any task would enumerate cliques for."""
    rows = [(f"c{i}", x) for i in range(900) for x in (f"H{i}", f"L{i // 2}", f"L{(i + 1) // 2}")]
    got = {r["cell_id"]: r["clone"] for r in cells.joint_clones(spark.createDataFrame(rows, "cell_id string, cluster string").distinct()).collect()}
    assert len(got) == 900
    assert got["c3"] == "H3+L1+L2" and got["c2"] == "H2+L1"


def test_definition_lines_with_angle_brackets(spark, tmp_path):
    (tmp_path / "b.fa").write_bytes(b">r1 note=a>b\r\nAC\r\nGT\r\n>r2 x > y\nTT\n\n>r3\n")
    got = {r["id"]: (r["description"], r["seq"]) for r in sequences.read_fasta(spark, str(tmp_path / "b.fa")).collect()}
    assert got == {"r1": ("r1 note=a>b", "ACGT"), "r2": ("r2 x > y", "TT"), "r3": ("r3", "")}


def test_pieces_lose_no_near_identical_pair(spark):
    rng = np.random.default_rng(4)
    base = ["".join(rng.choice(list("ACGT"), 33)) for _ in range(4)]
    seqs = sorted({b[:i] + "ACGT"[rng.integers(4)] + b[i + 1 : j] + "ACGT"[rng.integers(4)] + b[j + 1 :] for b in base for i in range(0, 30, 3) for j in (31, 32)} | set(base) | {"AC", "AG", ""})
    rows = [("v", "j", s, f"{k:03}") for k, s in enumerate(seqs)]
    got = {(r["a"], r["b"]) for r in clones.near_identical(spark.createDataFrame(rows, "v string, j string, junction string, id string")).collect()}
    want = {(a, b) for _, _, x, a in rows for _, _, y, b in rows if a < b and len(x) == len(y) and sum(p != q for p, q in zip(x, y, strict=True)) <= 0.1 * len(x) + 1e-9}
    assert got == want and want


def test_constant_segment_hits_are_exact(spark):
    c = "ACGGTTCAGCATTGACCGATAGGCTTAACG"
    germline = spark.createDataFrame([("IGHG1*01", c)], "allele string, seq string")
    reads = spark.createDataFrame([("same", "TT" + c), ("other", "TT" + c[:14] + "T" + c[15:]), ("short", c[:6])], "id string, seq string")
    got = {r["qid"]: r["identity"] for r in align.segment_hits(reads, germline, "C").collect()}
    assert got["same"] == 100.0 and "short" not in got and set(got.values()) == {100.0}


def test_optional_modules():
    import __spark_entry__

    assert __spark_entry__._optional("lymphlake.llm_absent", ("lymphlake.llm_absent",)) is None
    with pytest.raises(ModuleNotFoundError):
        __spark_entry__._optional("lymphlake.llm_absent", ("lymphlake.llm",))


def test_stop_codons_in_long_sequences(spark):
    from lymphlake.functions.seq import has_stop, translate_nt

    rows = [("GCA" * 20_000 + "TAA",), ("GCA" * 20_000 + "GTA",), ("ATAAGC",), ("taa",), ("",), (None,)]
    got = spark.createDataFrame(rows, "s string").select(has_stop(F.col("s")).alias("a"), translate_nt(F.col("s")).contains("*").alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got] == [True, False, False, True, False, None]


def test_demultiplex_kit(spark):
    from lymphlake.operators.cells import demultiplex

    reads = spark.createDataFrame([("a", "u1", "AACC"), ("a", "u2", "GG"), ("b", "u1", "AACC"), ("b", "u2", "TTTT"), ("c", "u1", None)], "cell string, umi string, seq string")
    kit = spark.createDataFrame([(2, "CC", "s2"), (1, "AA", "s1"), (3, "TT", "s3")], "place int, oligo string, sample string")
    got = {r["cell"]: (r["hash_sample"], r["n_umis"]) for r in demultiplex(reads, kit).collect()}
    assert got == {"a": ("s1", 1), "b": ("ambiguous", 2), "c": ("unknown", 0)}
    assert {r["hash_sample"] for r in demultiplex(reads, kit.limit(0)).collect()} == {"unknown"}
    with pytest.raises(ValueError):
        demultiplex(reads, kit, most_oligos=2)


def test_ids_are_not_shortened(spark):
    rows = spark.range(120_000).select(F.col("id").cast("string").alias("centroid"), (F.col("id") % 7).alias("clone_count"))
    got = clones.numbered(rows).agg(F.countDistinct("clone_id"), F.max(F.length("clone_id")), F.min(F.length("clone_id"))).first()
    assert tuple(got) == (120_000, 6, 5)


def test_rows_without_a_cell_make_no_cell(spark):
    cell = [("c", "IGH", f"s{i}", "IGHV1-1*01", "IGHJ1*01", "A" * 39 + "CG"[i], "good", 5 - i) for i in range(2)]
    bulk = [(None, "IGH", f"b{i}", "IGHV1-1*01", "IGHJ1*01", "A" * 40, "good", 1) for i in range(10_000)]
    t = spark.createDataFrame(cell + bulk, "cell_id string, locus string, sequence_id string, v_call string, j_call string, junction string, status string, duplicate_count long")
    assert [r["cell_id"] for r in cells.chain_summary(t).collect()] == ["c"]
    kept = cells.collapse_redundant(t)
    assert kept.count() == 10_001 and kept.where("cell_id IS NULL AND n_merged = 1 AND duplicate_count = 1").count() == 10_000
    chains = t.select("cell_id", F.concat("sequence_id", "junction").alias("cluster"))
    assert cells.chain_edges(chains).count() == 1
    assert [(r["cell_id"], r["clone"].count("+")) for r in cells.joint_clones(chains).collect()] == [("c", 1)]


def _mutate(deal, seq, p=0.1):
    out = []
    for c in seq:
        u = deal.random()
        out.append("" if u < p / 3 else c + deal.choice("ACGT") if u < 2 * p / 3 else deal.choice("ACGT") if u < p else c)
    return "".join(out)


@pytest.mark.parametrize("costs", [{}, {"gap_open": 5, "gap_extend": 2}])
def test_batched_alignments_equal_single_ones(costs):
    deal = random.Random(4)
    a = ["".join(deal.choice("ACGT") for _ in range(deal.choice([0, 1, 3, 20, 70]))) for _ in range(300)]
    b = [_mutate(deal, s)[deal.randrange(3) :] if deal.random() < 0.7 else "".join(deal.choice("AC") for _ in range(deal.randrange(30))) for s in a]
    assert batch_align.align_batch(a, b, cells=4000, **costs) == [align.align_pair(x, y, **costs) for x, y in zip(a, b, strict=True)]
    rows = np.array([list(b"ACGTACGTAC"), list(b"TTTTACGTAC")], np.uint8)
    for seq in ("ACGTACGTAC", "ACGTCGTAC", "GGGGGGGGGGG"):
        got = batch_align.banded_identities(rows, np.frombuffer(seq.encode(), np.uint8), 2)
        assert got == pytest.approx([align.banded_identity(bytes(r).decode(), seq, 2) for r in rows])


def test_long_insertions_give_two_hits(spark):
    deal = random.Random(9)
    genes = {f"IGHV{i}-1*01": "".join(deal.choice("ACGT") for _ in range(280)) for i in range(1, 6)}
    germline = spark.createDataFrame(list(genes.items()), "allele string, seq string")
    turn = str.maketrans("ACGT", "TGCA")
    reads, want = [], {}
    for n, (allele, gene) in enumerate(genes.items()):
        insertion = "".join(deal.choice("ACGT") for _ in range(30))
        made = gene[:120] + insertion + gene[120:]
        reads += [(f"i{n}", made), (f"m{n}", made.translate(turn)[::-1]), (f"s{n}", gene[:100] + gene[103:]), (f"x{n}", gene[20:])]
        want |= {f"i{n}": (allele, "plus", 1, 280, 1, 310), f"m{n}": (allele, "minus", 280, 1, 1, 310), f"s{n}": (allele, "plus", 1, 280, 1, 277), f"x{n}": (allele, "plus", 21, 280, 1, 260)}
    table = spark.createDataFrame([*reads, ("none", None), ("empty", ""), ("short", "ACG"), ("again", reads[0][1])], "id string, seq string")
    want["again"] = want["i0"]
    found = hsp.local_hit_table(table, germline)
    per = {(r["qid"], r["sid"]): r["n"] for r in found.groupBy("qid", "sid").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert all(per[q, w[0]] == (2 if q[0] in "ima" else 1) for q, w in want.items())
    got = {r["qid"]: (r["sid"], r["strand"], r["sstart"], r["send"], r["qstart"], r["qend"]) for r in hits.merged_hits(found).collect()}
    for q, w in want.items():
        if w[1] == "plus":
            assert got[q] == w
        else:
            assert got[q][:2] == w[:2] and got[q][4:] == w[4:]
    deletion = found.where("qid = 's0' AND hit_rank = 1").first()
    assert (deletion["gaps"], deletion["mismatches"], deletion["alignment"]) == (3, 0, 280)


def test_reads_without_segments_keep_their_status(spark):
    v = spark.createDataFrame([("IGHV1-1*01", "CAGGTGCAGCTGGTGCAGTCTGGGGCTGAGGTGAAGAAGCCTGGGTCCTCGGTGTATTACTGTGCGAGA")], "allele string, seq string")
    j = spark.createDataFrame([("IGHJ4*01", "ACTACTTTGACTACTGGGGCCAAGGAACCCTGGTCACCGTCTCCTCAG")], "allele string, seq string")
    seqs = [("a", v.first()["seq"] + "GGG" + j.first()["seq"]), ("b", v.first()["seq"]), ("c", "TTTTTTTTTTTTTTTTTTTT"), ("d", None), ("e", v.first()["seq"] + "T" * 40)]
    got = {r["sequence_id"]: r for r in rearrange.rearranged(spark.createDataFrame(seqs, "id string, seq string"), v, j).collect()}
    assert [got[x]["status"] for x in "bcde"] == ["noJ", "noV", "noV", "noJ"]
    assert got["a"]["junction"] == "TGTGCGAGAGGGACTACTTTGACTACTGG" and got["a"]["v_call"] == "IGHV1-1*01" and got["a"]["j_call"] == "IGHJ4*01"


def test_reads_with_gaps_keep_germline_places(spark):
    gene = "ATGGCTAGCTTCGGATCCAAACTGGTTCACGACTACTGCAAGGAA"
    reads = [("g", 1, 1, gene), ("g", 1, 2, gene[:18] + gene[21:]), ("g", 1, 3, gene[:18] + "TTTT" + gene[18:]), ("g", 1, 4, gene[:20] + gene[21:]), ("g", 1, 5, gene[6:]), ("g", 1, 6, None), ("h", 1, 7, gene)]
    got = profiles.residues_from_reads(spark.createDataFrame(reads, "vgene string, prof int, read_id long, seq string"), spark.createDataFrame([("g", gene)], "vgene string, seq string")).orderBy("read_id", "pos").collect()
    aa = {i: "".join(r["aa"] for r in got if r["read_id"] == i) for i in range(1, 8)}
    assert aa[1] == aa[3] == "MASFGSKLVHDYCKE" and aa[5] == "--SFGSKLVHDYCKE" and aa[6] == aa[7] == ""
    assert aa[2].count("-") + aa[2].count("X") in (1, 2) and sorted(set(aa[4])).count("X") == 1 and aa[4].replace("X", "") == aa[1][:6] + aa[1][7:]
    assert {r["germ_aa"] for r in got if r["pos"] == 1} == {"M"}


def test_consensus_across_deletions(spark):
    deal = random.Random(2)
    true = "".join(deal.choice("ACGT") for _ in range(120))
    reads = []
    for i in range(60):
        at = deal.randrange(5, 115)
        reads.append(true[:at] + true[at + 1 :] if i % 5 == 0 else true[:at] + deal.choice("ACGT") + true[at + 1 :])
    rows = [("c", "u", r) for r in reads] + [("c", "v", true[:40] + true[41:])] * 2 + [("c", "v", true)] * 3
    got = {r["umi"]: (r["n"], r["multi"], r["consensus"]) for r in barcodes.largest_cluster(spark.createDataFrame(rows, "cell string, umi string, seq string")).collect()}
    assert got == {"u": (60, 0, true), "v": (5, 0, true)}
    assert barcodes.star_consensus(true[:50] + true[51:], [true[:50] + true[51:], true], [1, 3]) == true


def test_greedy_rounds_equal_one_task(spark):
    deal = random.Random(5)
    base = ["".join(deal.choice("ACGT") for _ in range(30)) for _ in range(3)]
    rows = [("n0", None, 3, 0), ("e0", "", 3, 0), ("e1", "", 4, 0)]
    for i in range(150):
        seq = list(deal.choice(base))
        for _ in range(deal.randrange(7)):
            seq[deal.randrange(30)] = deal.choice("ACGT")
        rows.append((f"s{i:03d}", "".join(seq), deal.randrange(1, 50), i % 2))
    t = spark.createDataFrame(rows, "id string, seq string, n long, g int")
    order = [(-F.col("n")).alias("a"), F.col("id").alias("b")]
    one, many = (clones.cluster_blocks(t, [F.col("g"), F.length("seq")], "id", "seq", order, 0.9, block_rows=n).collect() for n in (4096, 0))
    assert sorted(map(tuple, one)) == sorted(map(tuple, many)) and len(one) == 152
    assert len({r["centroid"] for r in one}) > 6


def test_stretches_are_found_in_the_row_of_a_pair(spark):
    """All runs of equal places on every diagonal, of pairs of any lengths, without a word shuffled; chains of packed ones are those of flat ones."""
    deal = random.Random(5)
    genes = {f"g{i}": "".join(deal.choice("ACGTN") for _ in range(n)) for i, n in enumerate((3, 5, 40, 300))}
    reads = [(f"r{i}", "".join(deal.choice("acgtN") for _ in range(n))) for i, n in enumerate((0, 4, 5, 60, 700))] + [("whole", genes["g3"]), ("empty", None)]
    pairs = [(i, a, "plus", s) for i, s in reads for a in genes] + [("turned", "g3", "minus", genes["g3"].translate(str.maketrans("ACGT", "TGCA"))[::-1])]
    want = set()
    for i, a, strand, s in pairs:
        x, y = (s or "").upper() if strand == "plus" else genes["g3"], genes[a]
        for d in range(-len(y), len(x) + 1):
            begin = None
            for q in range(max(0, d), min(len(x), len(y) + d) + 1):
                same = q < min(len(x), len(y) + d) and x[q] == y[q - d]
                begin = q if same and begin is None else begin
                if not same and begin is not None:
                    want |= {(i, a, strand, d, begin, q - begin)} if q - begin >= 5 else set()
                    begin = None
    library = spark.createDataFrame(list(genes.items()), "allele string, seq string")
    rows = spark.createDataFrame(pairs, "id string, allele string, strand string, seq string")
    found = hsp.seed_stretches(rows.select("id", "seq").distinct(), library, rows, 5)
    assert "Window" not in found._jdf.queryExecution().toString()
    got = [tuple(r) for r in found.collect()]
    assert set(got) == want and len(got) == len(want) and ("turned", "g3", "minus", 0, 0, 300) in want
    packed = hsp.seed_chains(hsp.packed_stretches(rows, library, 5))
    assert sorted(packed.collect()) == sorted(hsp.seed_chains(found).collect())


def test_representatives_of_many_copies(spark):
    """Equal members are summed before places are taken apart; the first id of the best sequence stands for its copies."""
    rows = [("k", f"s{i:03}", "ACGT" if i % 2 else "ACGA", 1) for i in range(100)] + [("k", "t", "ACGT", 5), ("m", "u", "", 2), ("m", "v", None, 9), (None, "w", "A", 1)]
    found = clones.representatives(spark.createDataFrame(rows, "clone string, sequence_id string, junction string, duplicate_count long"))
    assert sorted(map(tuple, found.collect())) == [("k", "s001", 3 * 105 + 55), ("m", "u", 2)]
    assert found._jdf.queryExecution().analyzed().toString().count("Generate posexplode") == 1  # the weights; members are scored whole


def test_equal_reads_are_annotated_once(spark):
    """Copies, turned ones and repeated ids each get the row of their own sequence."""
    v = spark.createDataFrame([("IGHV1-1*01", "CAGGTGCAGCTGGTGCAGTCTGGGGCTGAGGTGAAGAAGCCTGGGTCCTCGGTGTATTACTGTGCGAGA")], "allele string, seq string")
    j = spark.createDataFrame([("IGHJ4*01", "ACTACTTTGACTACTGGGGCCAAGGAACCCTGGTCACCGTCTCCTCAG")], "allele string, seq string")
    whole = v.first()["seq"] + "GGG" + j.first()["seq"]
    seqs = [("a", whole), ("b", whole.lower()), ("a", v.first()["seq"]), ("a", None)]
    got = rearrange.rearranged(spark.createDataFrame(seqs, "id string, seq string"), v, j).collect()
    assert sorted((r["sequence_id"], r["status"], r["v_call"] is not None, r["junction"] is not None) for r in got) == [("a", "noJ", True, False), ("a", "noV", False, False), *[(x, got_status, True, True) for x, got_status in sorted((r["sequence_id"], r["status"]) for r in got if r["j_call"])]]
    assert len(got) == 4


def test_draws_sort_only_rows_below_a_bound(spark):
    """The draws are the first by md5 of all distinct reads, for genes large, small and null; most rows are never sorted."""
    rows = spark.range(40_000).select(F.when(F.col("id") % 100 == 0, "few").when(F.col("id") % 100 == 1, None).otherwise("many").alias("vgene"), (F.col("id") % 30_000).alias("read_id"))
    import hashlib

    want = set()
    for gene, ids in ((r["vgene"], r["ids"]) for r in rows.groupBy("vgene").agg(F.collect_set("read_id").alias("ids")).collect()):
        for draw in (1, 2):
            want |= {(gene, i, draw) for _, i in sorted((hashlib.md5(f"{i}:{draw}:0".encode()).hexdigest(), i) for i in ids)[:400]}
    found = profiles.sub_profiles(rows, 2, 400)
    got = [tuple(r) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)
    assert "Window" not in found._jdf.queryExecution().toString()  # the window ran on the rows below the bound only


def test_bounds_and_hits_are_sorted_together(spark):
    """A read's bound goes before its hits: no join, and hits without a read or a bound stay."""
    rows = [("a", "x", 1, 5, 30), ("a", "y", 2, 1, 10), ("a", "z", 3, 9, 99), ("b", "x", 1, 5, 99), (None, "x", 1, 5, 99), ("c", "x", 1, 2, 30)]
    table = spark.createDataFrame(rows, "qid string, sid string, hit_rank int, qstart int, qend int")
    j = spark.createDataFrame([("a", 20, 25), ("c", 20, 25), (None, 20, 25), ("other", 1, 2)], "qid string, qstart int, qend int")
    found = hits.bounded_hits(table, j, "D")
    assert "Join" not in found._jdf.queryExecution().toString() and found.columns == table.columns
    assert sorted((r["qid"] or "", r["sid"]) for r in found.collect()) == [("", "x"), ("a", "y"), ("a", "z"), ("b", "x")]
    assert sorted((r["qid"] or "", r["sid"]) for r in hits.bounded_hits(table, j, "C").collect()) == [("", "x"), ("b", "x")]


def test_what_a_task_sorts_does_not_grow(spark):
    from lymphlake.plans.tables import TASK_ROWS, dealt

    rows = spark.range(10)
    assert dealt(rows, TASK_ROWS, "id") is rows
    assert dealt(rows, 200 * TASK_ROWS, "id").rdd.getNumPartitions() == 200


def test_residues_meet_a_written_rarity_table(spark, sf):
    """The table of rare residues and the aligned pairs are small files, so their sizes are known when reads meet them."""
    plan = QUERIES["rare_substitutions_from_reads"](spark, sf)._jdf.queryExecution()
    assert "avg(" not in plan.analyzed().toString() and "SortMergeJoin" not in plan.executedPlan().toString()
