"""In-silico digestion: how many candidate peptides a database holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from psmlake.functions.arrays import let, running_ends

#: Cut sites by enzyme number; 0 cuts anywhere, 9 nowhere.
CUT_SITES = {0: None, 1: "(?<=[KR])(?!P)", 2: "(?<=[FYWL])(?!P)", 3: "(?<=[K])(?!P)", 4: "(?=[K])", 5: "(?<=[ED])(?!P)", 6: "(?<=[R])(?!P)", 7: "(?=[DE])", 9: None}


def fragments(sequence: Column, enzyme: int, compat: bool = False) -> Column:
    """Pieces between cut sites.  Empty pieces go; compat keeps the ones at the ends that a split leaves there."""
    site = CUT_SITES[enzyme]
    parts = F.split(sequence, site)
    if not compat:
        return F.filter(parts, lambda p: p != "")
    if site.startswith("(?="):  # an empty piece before a first residue that is cut
        return F.when(sequence.rlike(site.replace("(?=", "^(?:")), F.concat(F.array(F.lit("")), parts)).otherwise(parts)
    return parts


def _windows(n: Column, low: int, high: int) -> Column:
    """Substrings of n residues with low to high residues."""
    top = F.least(F.lit(high), n)
    k = top - low + 1
    return F.when(k > 0, k * (n + 1) - (F.lit(low) + top) * k / 2).otherwise(0).cast("long")


#: Starts to a block of running sums.  Those of a whole sequence would be copied once for each piece.
BLOCK = 16


def _run_lengths(lengths: Column, missed: int) -> Column:
    """Lengths of runs of neighbouring pieces, by first piece, then last, from the pieces' own (at least one); work in proportion to the pieces where `missed` is not negative."""
    last = F.size(lengths)
    if missed == 0:
        return lengths
    block = max(BLOCK, missed + 1)

    def spans(ends: Column, starts: Column) -> Column:
        def from_start(i: Column) -> Column:
            reach = F.size(ends) - 1 if missed < 0 else F.least(F.size(ends) - 1, i + missed + 1)
            return F.transform(F.sequence(i + 1, reach), lambda j: F.element_at(ends, j + 1) - F.element_at(ends, i + 1))

        return F.flatten(F.transform(F.sequence(F.lit(0), starts - 1), from_start))

    if missed < 0:
        return let(running_ends(lengths), lambda ends: spans(ends, last))
    return F.flatten(F.transform(F.sequence(F.lit(0), last - 1, F.lit(block)), lambda k: let(running_ends(F.slice(lengths, k + 1, F.lit(block + missed))), lambda ends: spans(ends, F.least(F.lit(block), last - k)))))


def _piece_lengths(sequence: Column, enzyme: int, compat: bool) -> Column:
    return F.transform(fragments(sequence, enzyme, compat), lambda p: F.length(p))


def span_lengths(sequence: Column, enzyme: int, missed: int, compat: bool = False) -> Column:
    """Lengths of runs of neighbouring pieces with at most `missed` cut sites inside (-1: any number)."""
    return let(_piece_lengths(sequence, enzyme, compat), lambda own: F.when(F.size(own) > 0, _run_lengths(own, missed)).otherwise(F.array().cast("array<int>")))


def peptides(sequence: Column, enzyme: int = 1, missed: int = 0, min_length: int = 6, max_length: int = 40) -> Column:
    """The runs of up to `missed` + 1 neighbouring pieces with min_length to max_length residues, repeated ones too."""
    if CUT_SITES.get(enzyme) is None:
        raise ValueError(f"enzyme {enzyme} has no cut sites")

    def runs(parts: Column) -> Column:
        def of(k: int) -> Column:
            starts = F.when(F.size(parts) > k, F.slice(parts, F.lit(1), F.size(parts) - k)).otherwise(F.array().cast("array<string>"))
            return F.transform(starts, lambda p, i: F.concat(p, *[F.get(parts, i + j) for j in range(1, k + 1)])) if k else parts

        return F.filter(F.concat(*[of(k) for k in range(missed + 1)]), lambda p: F.length(p).between(min_length, max_length))

    return let(fragments(sequence, enzyme), runs)


def _semi_specific(n_pieces: Column, spans: Column, most_pieces: int | None, low: int, high: int) -> Column:
    """Over all runs, the lengths from `low` to the run's own or `high`; `spans` holds the lengths of the runs that may be shorter than `high`."""
    each = F.aggregate(spans, F.lit(0).cast("long"), lambda a, n: a + F.greatest(F.lit(0), F.least(F.lit(high), n) - low + 1))
    n = n_pieces.cast("long")
    most = n if most_pieces is None else F.least(F.lit(most_pieces).cast("long"), n)
    runs = most * n - (most * (most - 1) / 2).cast("long")  # of 1 to `most` pieces
    return each + (runs - F.size(spans)) * max(0, high - low + 1)


def candidates(sequence: Column, min_length: int = 6, max_length: int = 40, missed: int = -1, termini: int = 2, enzyme: int = 1, compat: bool = False) -> Column:
    """How many candidates of min_length to max_length residues a sequence has, as candidate_peptides() counts them."""
    if enzyme not in CUT_SITES:
        raise ValueError(f"unknown enzyme {enzyme}; known: {', '.join(map(str, CUT_SITES))}")
    seq = F.upper(sequence)
    longest = max_length + 2  # a run of more pieces is longer than max_length
    pieces = min(missed, longest) if missed >= 0 else longest
    if CUT_SITES[enzyme] is None:
        return _windows(F.length(seq), min_length, max_length)
    if termini < 2:
        def semi(own: Column) -> Column:
            return let(_run_lengths(own, pieces), lambda spans: _semi_specific(F.size(own), spans, missed + 1 if missed >= 0 else None, min_length, max_length))

        return F.when(F.length(seq) > 0, let(_piece_lengths(seq, enzyme, compat), lambda own: F.when(F.size(own) > 0, semi(own)).otherwise(0))).otherwise(0).cast("long")
    return F.size(F.filter(span_lengths(seq, enzyme, pieces, compat), lambda n: (n >= min_length) & (n <= max_length))).cast("long")


def candidate_peptides(proteins: DataFrame, min_length: int = 6, max_length: int = 40, missed: int = -1, termini: int = 2, enzyme: int = 1, compat: bool = False, sequence: str = "Sequence") -> DataFrame:
    """One row: n_peptides, candidates of min_length to max_length residues over all proteins.

    With both termini cut (termini = 2) they are runs of pieces; with fewer, each run of pieces counts once for every length up to its own, as the search's size estimate does;
    with an enzyme without sites they are all substrings.
    """
    return proteins.agg(F.coalesce(F.sum(candidates(F.col(sequence), min_length, max_length, missed, termini, enzyme, compat)), F.lit(0)).alias("n_peptides"))
