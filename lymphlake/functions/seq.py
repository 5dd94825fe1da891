"""Sequence functions as Column expressions: everything stays in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = "TCAG"
#: The standard code in T, C, A, G order of the three bases; a fixed value.
CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
AMINO_ACIDS = "ACDEFGHIKLMNPQRSTVWY"
CODONS = {a + b + c: CODE[16 * i + 4 * j + k] for i, a in enumerate(BASES) for j, b in enumerate(BASES) for k, c in enumerate(BASES)}
# IUPAC codes and the bases that they stand for.
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "[UT]", "U": "[UT]", "M": "[AC]", "R": "[AG]", "W": "[AT]", "S": "[CG]", "Y": "[CT]", "K": "[GT]", "V": "[ACG]", "H": "[ACT]", "D": "[AGT]", "B": "[CGT]", "N": "[ACGTU]"}


def codons(seq: Column) -> Column:
    """Array of whole codons; a partial one at the end is dropped."""
    n = F.floor(F.length(seq) / 3).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(seq, i * 3 + 1, F.lit(3)))).when(n == 0, F.array().cast("array<string>"))


def _amino(codon: Column) -> Column:
    """The codon's letter in ``CODE``, X if it is none: its place in the list of all codons."""
    at = F.instr(F.lit(" ".join(CODONS)), codon)
    return F.when(at > 0, F.substr(F.lit(CODE), ((at + 3) / 4).cast("int"), F.lit(1))).otherwise("X")


def translate_nt(seq: Column) -> Column:
    """Amino acids of a nucleotide sequence: stop is *, a codon that is not four-letter DNA is X."""
    return F.array_join(F.transform(codons(F.upper(seq)), lambda c: _amino(c)), "")


def translate_gapped(seq: Column) -> Column:
    """As :func:`translate_nt`, but a codon of three gaps is a gap."""
    return F.array_join(F.transform(codons(F.upper(seq)), lambda c: F.when(c == "---", "-").otherwise(_amino(c))), "")


def has_stop(seq: Column) -> Column:
    """Whether the translation has a stop: one scan over whole codons, no array."""
    return F.upper(seq).rlike(r"^(?:...)*?T(?:AA|AG|GA)")


def translate_strict(seq: Column) -> Column:
    """Null when an N stands anywhere but in the first place."""
    return F.when(F.locate("N", F.upper(seq), 2) == 0, translate_nt(seq))


def revcomp(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTUacgtuRYKMBVDHrykmbvdh", "TGCAAtgcaaYRMKVBHDyrmkvbhd"))


def degap(seq: Column) -> Column:
    return F.regexp_replace(seq, r"[-.+]", "")


def iupac_to_regex(motif: str) -> str:
    """Regular expression of a motif; letters that are no code stay."""
    return "".join(IUPAC.get(c, c) for c in motif.upper())


def gene_of(call: Column) -> Column:
    """Gene of the first call of a comma list, without the allele."""
    return F.split_part(F.split_part(call, F.lit(","), F.lit(1)), F.lit("*"), F.lit(1))


def allele_list(call: Column) -> Column:
    return F.split(call, ",")


def locus_of(name: Column) -> Column:
    """IGH, IGL or IGK by the V or J name, null if neither."""
    rules = (("IGH", "(?i)HV|VH|HJ|JH|heavy"), ("IGL", "(?i)LV|VL|LJ|JL|lambda"), ("IGK", "(?i)KV|VK|KJ|JK|kappa"))
    return F.coalesce(*[F.when(name.rlike(p), locus) for locus, p in rules])


def isotype_fallback(after_j: Column, v_locus: Column) -> Column:
    """Constant gene by the first bases after J; null if it contradicts the V locus or nothing fits."""
    rules = (("^C[CT]", "IGHG"), ("^GGA", "IGHM"), ("^CAT", "IGHA"), ("^CAC", "IGHD"), ("^CGA", "IGKC"), ("^GGT", "IGLC"))
    found = F.coalesce(*[F.when(after_j.rlike(p), gene) for p, gene in rules])
    return F.when(found.contains(v_locus), found)


def last_match(text: Column, pattern: str) -> Column:
    """Struct ``start, stop, match`` (0-based, end exclusive) of the last match, null if none."""
    every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.split(text, pattern)
    tail = F.length(F.element_at(parts, -1))
    last = F.element_at(every, -1)
    return F.when(F.size(every) > 0, F.struct((F.length(text) - tail - F.length(last)).alias("start"), (F.length(text) - tail).alias("stop"), last.alias("match")))


def cdr3_charge(aa: Column) -> Column:
    return F.regexp_count(aa, F.lit("(?i)[KR]")) - F.regexp_count(aa, F.lit("(?i)[DE]"))


def features(indel: Column, stop: Column) -> Column:
    return F.when(indel & stop, "both").when(indel, "in-del").when(stop, "stop").otherwise("orf")


def divergence(identity: Column) -> Column:
    return 100 * (1 - identity)


def decimal_year(day: Column) -> Column:
    """Year and day of the year over 365, never reaching the next year."""
    leap_day = (F.month(day) > 2) & (F.dayofyear(F.last_day(F.make_date(F.year(day), F.lit(2), F.lit(1)))) == 60)
    n = F.dayofyear(day) - F.when(leap_day, 1).otherwise(0)
    return F.year(day) + F.least(n / 365, F.lit(0.99999))


def split_regions(seq: Column, borders: list[int]) -> Column:
    """Struct ``fw, cdr``: stretches between 4 or 6 borders (0-based) belong to cdr and fw in turn."""
    if len(borders) not in (4, 6):
        raise ValueError("4 or 6 borders")
    ends = [0, *borders]
    pieces = [F.substring(seq, a + 1, b - a) for a, b in zip(ends, borders, strict=False)] + [F.substr(seq, F.lit(borders[-1] + 1))]
    return F.struct(F.concat(*pieces[0::2]).alias("fw"), F.concat(*pieces[1::2]).alias("cdr"))


def codon_positions(seq: Column) -> Column:
    """Struct ``first_two, third`` of the whole codons."""
    c = codons(seq)
    return F.struct(F.array_join(F.transform(c, lambda x: F.substring(x, 1, 2)), "").alias("first_two"), F.array_join(F.transform(c, lambda x: F.substring(x, 3, 1)), "").alias("third"))


def gene_alias(call: Column) -> Column:
    """Profile gene of an allele: one known alias, distal D genes with their twins, no allele."""
    moved = F.regexp_replace(call, r"IGHV4-4\*0[78]", "IGHV4-59*11")
    return F.regexp_replace(F.regexp_replace(moved, r"\*.*$", ""), r"(\d)D(?=$|-)", "$1")


def letters(seq: Column) -> Column:
    return F.split(seq, "")


def shannon(profile: Column) -> Column:
    """Base-2 entropy of an array of shares; 0 log 0 is 0."""
    return F.aggregate(profile, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def normalised(profile: Column) -> Column:
    """Shares that add up to 1; all zero becomes uniform."""
    total = F.aggregate(profile, F.lit(0.0), lambda a, p: a + p)
    return F.transform(profile, lambda p: F.when(total > 0, p / total).otherwise(1.0 / F.size(profile)))


def jsd(a: Column, b: Column) -> Column:
    """Base-2 Jensen-Shannon divergence of two profiles, each normalised first."""
    a, b = normalised(a), normalised(b)
    return shannon(F.zip_with(a, b, lambda x, y: (x + y) / 2)) - (shannon(a) + shannon(b)) / 2


def letter_profile(aa: Column) -> Column:
    """One-hot array over the 20 amino acids; anything else, X too, is all zeros."""
    return F.array(*[F.when(aa == x, 1.0).otherwise(0.0) for x in AMINO_ACIDS])


def phred(qual: Column) -> Column:
    return F.transform(letters(qual), lambda c: F.ascii(c) - 33)


def min_phred_ok(qual: Column, least: int = 20) -> Column:
    """Whether no base lies under ``least``."""
    return ~F.exists(phred(qual), lambda q: q < least)


def truncate_by_error(seq: Column, qual: Column, most: float = 5.0) -> Column:
    """The longest prefix whose expected errors stay within ``most``."""
    errors = F.transform(phred(qual), lambda q: F.pow(F.lit(10.0), -q / 10.0))
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n"), F.lit(False).alias("over"))

    def step(acc, e):
        over = acc["over"] | (acc["sum"] + e > most)
        return F.struct((acc["sum"] + e).alias("sum"), F.when(over, acc["n"]).otherwise(acc["n"] + 1).alias("n"), over.alias("over"))

    return F.substring(seq, F.lit(1), F.aggregate(errors, start, step, lambda acc: acc["n"]))


def identity(a: Column, b: Column, terminal_gaps: bool = False, internal_gaps: bool = False, skip_n: bool = True) -> Column:
    """Struct ``matches, aligned, identity`` of two aligned strings of equal length.

    Columns with a gap in either count only if asked for: terminal ones are
    those before the first or after the last residue of either row.
    """

    def inner(s):
        return F.length(s) - F.length(F.ltrim(F.replace(s, F.lit("-"), F.lit(" ")))), F.length(F.rtrim(F.replace(s, F.lit("-"), F.lit(" "))))

    (a0, a1), (b0, b1) = inner(a), inner(b)
    begin, end = F.greatest(a0, b0), F.least(a1, b1)
    pairs = F.zip_with(F.zip_with(letters(a), letters(b), lambda x, y: F.struct(x.alias("x"), y.alias("y"))), F.sequence(F.lit(0), F.length(a) - 1), lambda p, i: F.struct(p["x"].alias("x"), p["y"].alias("y"), i.alias("i")))
    gap = lambda p: (p["x"] == "-") | (p["y"] == "-")
    inside = lambda p: (p["i"] >= begin) & (p["i"] < end)

    def counted(p):
        keep = ~gap(p)
        if internal_gaps:
            keep = keep | (gap(p) & inside(p))
        if terminal_gaps:
            keep = keep | (gap(p) & ~inside(p))
        return keep & ~((p["x"] == "N") | (p["y"] == "N")) if skip_n else keep

    used = F.filter(pairs, counted)
    matches = F.size(F.filter(used, lambda p: p["x"] == p["y"]))
    return F.struct(matches.alias("matches"), F.size(used).alias("aligned"), F.when(F.size(used) > 0, matches / F.size(used)).alias("identity"))


def hamming(a: Column, b: Column) -> Column:
    """Differing positions of two strings of equal length."""
    return F.size(F.filter(F.zip_with(letters(a), letters(b), lambda x, y: x != y), lambda d: d))


def gap_aware_distance(a: Column, b: Column, skip_n: bool = True) -> Column:
    """Struct ``distance, compared, positions``: sites with a gap (or N) in either are skipped; positions are 0-based."""
    skip = ["-", "N"] if skip_n else ["-"]
    marks = F.zip_with(letters(a), letters(b), lambda x, y: F.when(x.isin(*skip) | y.isin(*skip), F.lit(None).cast("boolean")).otherwise(x != y))
    at = F.filter(F.sequence(F.lit(0), F.length(a) - 1), lambda i: F.coalesce(F.element_at(marks, i + 1), F.lit(False)))
    return F.struct(F.size(at).alias("distance"), F.size(F.filter(marks, lambda m: m.isNotNull())).alias("compared"), at.alias("positions"))


def motif_frequency(seq: Column, motif: str) -> Column:
    """Struct ``n, per_base`` of the overlapping matches of an IUPAC motif."""
    n = F.regexp_count(F.upper(seq), F.lit(f"(?={iupac_to_regex(motif)})"))
    return F.struct(n.alias("n"), F.when(F.length(seq) > 0, n / F.length(seq)).alias("per_base"))


def sub_label(germline: Column, pos: Column, aa: Column) -> Column:
    """``S31N``."""
    return F.concat(germline, pos.cast("string"), aa)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, conditions, F.lit(False))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x & y, conditions, F.lit(True))
