"""Line dedup by a segment-partition edit join.

Lengths are dealt into narrow bands, and every distinct line has `edits + 1` segments whose places are those of its
band: a line within `edits` edits must contain one of them unchanged, at nearly the same place from its start or end.
Each line therefore probes, for its own band and the one below if a line short enough may be there, only the substrings
at places that the multi-match rule allows. Lines that share a segment are compared with the earliest of them first,
those still not near one with ever more, by a banded bit-parallel edit distance.
Longer lines may also differ in whole words, in more of them the longer they are: the same join is
made on words, with segments for the threshold of the shorter line, so that a line probes into the
band below its own; from where 2 words may differ, numbers of words are dealt into bands too.
Everything is DataFrame and SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfold.llm.common import GAP, join_few, kept_table, words as words_of

#: Words from which a line may differ in 1, 2 and 3 of them from a near one.
WORDS = (8, 40, 80)


def with_cuts(lines: DataFrame, edits: int, least: int) -> DataFrame:
    """Add what the signatures of a line need, so that its length is taken once.

    n is the length, low_0 the least length of its band, low_1 that of the band below if a line of at
    least `least` characters that is up to `edits` shorter may be in it, else NULL; size_0 and size_1 are
    the sizes of the segments in these bands. Bands are 4 characters wide, those from 64, 128 and 256 on 8, 16
    and 32 (or as many times more as more edits need), so that lines within the edits are in one band or in
    two next to each other.
    """
    wide = 4 * max(1, -(-edits // 4))
    widths = " ".join(f"WHEN {{0}} < {16 * wide * k} THEN {wide * k}" for k in (1, 2, 4))
    band = f"{{0}} - {{0}} % CASE {widths} ELSE {8 * wide} END"
    lines = lines.withColumn("n", F.length("line"))
    lines = lines.withColumns(
        {"low_0": F.expr(band.format("n")), "below": F.expr(band.format(f"greatest(n - {edits}, least(n, {least}))"))}
    )
    lines = lines.withColumn("low_1", F.expr("if(below < low_0, below, NULL)")).drop("below")
    return lines.withColumns({f"size_{b}": F.expr(f"low_{b} div {edits + 1}").cast("int") for b in (0, 1)})


def _places(edits: int) -> list[tuple[int, int]]:
    """(i, move) of all places at which a line may have segment i of one that is not longer, within the edits.

    Segments of the first half have their places from the start, the others from the end. Of the segments
    that the edits leave unchanged one has no more edits before it than segments, and as many after it.
    """
    return [(i, d) for i in range(edits + 1) for d in range(-min(i, edits - i), min(i, edits - i) + 1)]


def _char_plan(edits: int) -> str:
    """SQL: what a line has signatures of, its own segments first; the band below has no own ones."""
    own, tried = [(0, i, d) for i, d in _places(edits) if not d], [(0, i, d) for i, d in _places(edits) if d]
    here = _structs(("t", "s", "i", "d"), [(-1, *x) for x in own + tried])
    both = _structs(("t", "s", "i", "d"), [(-1, *x) for x in own + tried + [(1, i, d) for i, d in _places(edits)]])
    return f"if(low_1 IS NULL, {here}, {both})"


def _char_signature(edits: int) -> str:
    """SQL: hash of the band, the segment number i and its text, d places further; s is 1 for the band below.

    A place outside the line gives another text than a segment's: it finds nothing that the
    verification would keep.
    """
    low, size = "if(s = 0, low_0, low_1)", "if(s = 0, size_0, size_1)"
    start = f"if(2 * i <= {edits}, {size} * i, n - {size} * ({edits + 1} - i))"
    return f"xxhash64({low}, i, substring(line, {start} + 1 + d, {size}))"


def _structs(names: tuple[str, ...], rows: list[tuple[int, ...]]) -> str:
    fields = [", ".join(f"'{k}', {v}" for k, v in zip(names, row)) for row in rows]
    return f"array({', '.join(f'named_struct({x})' for x in fields)})"


def _allowed(n: str, words: tuple[int, ...]) -> str:
    """SQL: how many words lines may differ in of which the shorter one has n."""
    return " + ".join(f"CAST({n} >= {least} AS INT)" for least in words)


def _word_plan(m: int, words: tuple[int, ...]) -> list[tuple[int, int, int, int]]:
    """What a line of m words has signatures of: (t, s, i, d), its own segments first.

    t is the threshold of a line with s words less, i the segment and d its move.
    """
    own, tried = [], []
    for s in range(len(words) + 1):
        t = sum(m - s >= least for least in words)
        for i in range(t + 1 if s <= t and t else 0):
            for d in range(max(-i, s - (t - i)), min(i, s + (t - i)) + 1):
                (tried if s or d else own).append((t, s, i, d))
    return own + tried


def _word_plans(words: tuple[int, ...]) -> str:
    """SQL: the plan of a line of m words.

    It is a constant between two numbers of words at which it changes, so that nothing but what a
    line has is computed for it.
    """
    cases = ""
    for m in sorted({least + s for least in words for s in range(len(words) + 1)}, reverse=True):
        cases += f"WHEN m >= {m} THEN {_structs(('t', 's', 'i', 'd'), _word_plan(m, words))} "
    return f"CASE {cases} ELSE CAST(array() AS array<struct<t:int,s:int,i:int,d:int>>) END"


def _word_signature(p: str = "") -> str:
    """SQL: hash of the number of words, the segment number and its words, d places further.

    Segment i of n words ends before word n * (i + 1) div (t + 1).
    """
    start, end = (f"CAST((m - {p}s) * {i} div ({p}t + 1) AS INT)" for i in (f"{p}i", f"({p}i + 1)"))
    return f"xxhash64('words', m - {p}s, {p}i, slice(w, {start} + 1 + {p}d, {end} - {start}))"


def word_signatures(words: tuple[int, ...]) -> Column:
    """Signatures of a line's words w, whose number is m: of its t + 1 segments, then of what it probes."""
    return F.expr(f"transform({_word_plans(words)}, p -> {_word_signature('p.')})")


def _banded_from(words: tuple[int, ...]) -> int:
    """The threshold from which numbers of words have bands: 2, or none where a threshold holds for too few."""
    wide = all(b - a >= len(words) for a, b in zip(words[1:], words[2:]))
    return 2 if wide and all(least > t for t, least in enumerate(words, 1)) else len(words) + 1


def _word_low(m: str, words: tuple[int, ...]) -> str:
    """SQL: the least number of words of the band of lines with m words; one threshold holds in a band.

    Bands are 8 words wide where lines may differ in 2 words, 16 where in 3. What is left before the
    next threshold belongs to the last band, so that none is narrower than its threshold.
    """
    cases = ""
    for t in range(len(words), _banded_from(words) - 1, -1):
        base, wide = words[t - 1], 2 << t
        at = f"({m} - {base}) div {wide}"
        if t < len(words):
            at = f"least({at}, {max(1, (words[t] - base) // wide) - 1})"
        cases += f"WHEN {m} >= {base} THEN CAST({base} + {wide} * ({at}) AS INT) "
    return f"CASE {cases} END" if cases else "CAST(NULL AS INT)"


def _with_words(lines: DataFrame, words: tuple[int, ...]) -> DataFrame:
    """Add the words w of a line, their number m, the least one v_0 of its band and that of the band below.

    The latter, v_1, is NULL where no line of that band is near enough. There is no lambda, and few
    lines need GAP.
    """
    line = F.col("line")
    cut = F.when(line.rlike(r"[\x09-\x0D]"), F.split(line, GAP)).otherwise(F.split(line, " "))
    cut = lines.withColumn("w", F.array_remove(cut, "")).withColumn("m", F.size("w"))
    cut = cut.withColumn("v_0", F.expr(_word_low("m", words)))
    reach = f"m - ({_allowed('(v_0 - 1)', words)}) < v_0"
    return cut.withColumn("v_1", F.expr(f"if({reach}, {_word_low('(v_0 - 1)', words)}, NULL)"))


def _word_band_plans(words: tuple[int, ...]) -> str:
    """SQL: the plan of a line, by bands where its number of words has them: s is 1 for the band below."""
    names, first = ("t", "s", "i", "d"), _banded_from(words)
    cases = ""
    for t in range(len(words), first - 1, -1):
        base = words[t - 1]
        own = [(t, 0, i, d) for i, d in _places(t) if not d] + [(t, 0, i, d) for i, d in _places(t) if d]
        below, lower = ([(x, 1, i, d) for i, d in _places(x)] for x in (t, t - 1))
        if t == first:
            # what has no bands is below: few numbers of words still reach there
            for m in range(base + t - 1, base - 1, -1):
                lower = [x for x in _word_plan(m, words) if x[0] < first]
                cases += f"WHEN m = {m} THEN {_structs(names, own + lower)} "
        else:
            cases += f"WHEN v_0 = {base} AND v_1 IS NOT NULL THEN {_structs(names, own + lower)} "
        cases += f"WHEN m >= {base} AND v_1 IS NOT NULL THEN {_structs(names, own + below)} "
        cases += f"WHEN m >= {base} THEN {_structs(names, own)} "
    return f"CASE {cases} ELSE {_word_plans(words)} END" if cases else _word_plans(words)


def _word_band_signature(words: tuple[int, ...]) -> str:
    """SQL: hash of the band, the segment number and its words, d places further, as for characters."""
    low = "if(s = 0, v_0, v_1)"
    size = f"({low} div (t + 1))"
    start = f"if(2 * i <= t, {size} * i, m - {size} * (t + 1 - i))"
    by_band = f"xxhash64('bands', {low}, i, slice(w, CAST({start} AS INT) + 1 + d, CAST({size} AS INT)))"
    return f"if(t < {_banded_from(words)}, {_word_signature()}, {by_band})"


def _word_hashes(line: str) -> Column:
    return F.transform(words_of(F.col(line)), lambda x: F.xxhash64(x))


def _shared(a: str, b: str) -> str:
    """SQL: length of the common prefix of two columns, by bisection."""
    return (
        f"aggregate(reverse(sequence(0, CAST(floor(log2(length({a}) + 1)) AS INT))), 0, (n, e) -> "
        f"if(n + shiftleft(1, e) <= least(length({a}), length({b})) AND "
        f"left({a}, n + shiftleft(1, e)) = left({b}, n + shiftleft(1, e)), n + shiftleft(1, e), n))"
    )


def _banded(edits: int, first: int | None = None) -> str:
    """SQL: edit distance of the character arrays x and y (x not shorter, longer than `edits`).

    Bit-parallel along the diagonal band (Hyyrö 2003): word bit `top` is the cell `edits` below the
    diagonal; only distances up to `edits` are exact. With `first`, only so many steps are made and
    the result is a lower bound of the distance minus `edits`.
    """
    top = 2 * edits + 1
    mask = (1 << (top + 1)) - 1
    match = " | ".join(
        f"if(i + {k} >= 0 AND i + {k} < size(x) AND get(x, greatest(i + {k}, 0)) = get(y, i), "
        f"{1 << (top - edits + k)}L, 0L)"
        for k in range(-edits, edits + 1)
    )
    # the parts of a step are bound one after the other by one-element transforms
    bind = (
        "aggregate(array({m}), s, (s, m) -> aggregate(array(((((m & s.vp) + s.vp) ^ s.vp) | m | s.vn) & {mask}L), "
        "s, (s, d) -> aggregate(array(struct((s.vn | ~(d | s.vp)) & {mask}L AS hp, d & s.vp AS hn)), s, (s, h) -> "
        "named_struct('vp', (h.hn | ~(shiftrightunsigned(d, 1) | h.hp)) & {mask}L, "
        "'vn', shiftrightunsigned(d, 1) & h.hp, 'n', "
        "if(i < size(x) - {edits}, s.n + if((d & {diagonal}L) = 0L, 1, 0), "
        "s.n + if((h.hp & shiftright({diagonal}L, 1 + i - (size(x) - {edits}))) <> 0L, 1, 0) "
        "- if((h.hn & shiftright({diagonal}L, 1 + i - (size(x) - {edits}))) <> 0L, 1, 0))))))"
    ).format(m=match, mask=mask, edits=edits, diagonal=1 << top)
    start = ((1 << (edits + 1)) - 1) << (top - edits)
    steps = "size(y)" if first is None else f"least(size(y), greatest(size(x) - {edits}, 0), {first})"
    return (
        f"aggregate(if({steps} > 0, sequence(0, {steps} - 1), array()), "
        f"named_struct('vp', {start}L, 'vn', 0L, 'n', {edits}), (s, i) -> {bind}, s -> s.n)"
    )


def edit_distance(pairs: DataFrame, left: str, right: str, edits: int, maybe: str = "true") -> DataFrame:
    """Add `distance`: the edit distance of two columns if it is at most `edits`, else `edits + 1`.

    Where the SQL condition `maybe` is false it is known to be more, and not computed.
    What the strings share at their ends is cut off; strings that differ too much within the first
    steps of the band are given up there.
    """
    a, b = F.col(left), F.col(right)
    longer = F.length(a) >= F.length(b)
    keep = pairs.columns
    # nothing is cut or compared where the distance is known to be more
    cut = pairs.withColumn("within", F.expr(f"({maybe}) AND abs(length({left}) - length({right})) <= {edits}"))
    cut = cut.withColumns(
        {"x": F.when(F.col("within"), F.when(longer, a).otherwise(b)).otherwise(""),
         "y": F.when(F.col("within"), F.when(longer, b).otherwise(a)).otherwise("")}
    )
    keep = [*keep, "within"]
    cut = cut.withColumn("p", F.expr(_shared("x", "y")))
    cut = cut.select(
        *keep, F.expr("substring(x, p + 1)").alias("x"), F.expr("substring(y, p + 1)").alias("y")
    )
    cut = cut.withColumns({"rx": F.reverse("x"), "ry": F.reverse("y")})
    # the band needs more characters than edits, so that many of the shared end stay
    cut = cut.withColumn("q", F.expr(f"greatest({_shared('rx', 'ry')} - {edits + 1}, 0)"))
    cut = cut.select(
        *keep,
        F.expr("split(left(x, length(x) - q), '')").alias("x"),
        F.expr("split(left(y, length(y) - q), '')").alias("y"),
    )
    cut = cut.withColumns(
        {c: F.expr(f"if(size({c}) = 1 AND {c}[0] = '', array(), {c})") for c in ("x", "y")}
    )
    # very short rests get the same ending, which changes no distance
    ending = ", ".join(["'\\u0000'"] * (edits + 1))
    cut = cut.withColumns({c: F.expr(f"concat({c}, array({ending}))") for c in ("x", "y")})
    # a first part that is all there is would be compared twice
    cut = cut.withColumn("early", F.expr(f"if(NOT within, {2 * edits + 1}, if(size(y) > 32, {_banded(edits, 32)}, 0))"))
    return cut.select(
        *pairs.columns,
        F.expr(
            f"if(early > {2 * edits} OR size(x) - size(y) > {edits}, {edits + 1}, "
            f"least({_banded(edits)}, {edits + 1}))"
        ).alias("distance"),
    )


def _lines(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, line_no, line) of all lines of at least so many characters."""
    split = F.split(F.coalesce("text", F.lit("")), "\n")
    return (
        docs.select("doc_id", F.posexplode(split).alias("line_no", "line"))
        .where(F.length("line") >= least)
    )


def _keys() -> list[Column]:
    return [F.xxhash64("line").alias("k"), F.xxhash64("line", F.lit(1)).alias("k2")]


def _text_of(docs: DataFrame, wanted: DataFrame, few: bool) -> DataFrame:
    """(no, line) of wanted distinct lines (no, k, k2, at), taken from the document named by at."""
    places = wanted.groupBy(F.col("at.doc_id").alias("id")).agg(
        F.collect_list(F.struct("at.line_no", "k", "k2", "no")).alias("places")
    )
    same = F.col("doc_id").eqNullSafe(F.col("id"))
    if few:
        found = join_few(docs, kept_table(places, "places"), same)
    else:
        found = docs.join(places.hint("merge"), same)
    split = found.select(F.split("text", "\n").alias("lines"), "places")
    got = F.transform(
        "places",
        lambda x: F.struct(
            x["k"].alias("k"), x["k2"].alias("k2"), x["no"].alias("no"), F.get("lines", x["line_no"]).alias("line")
        ),
    )
    # ids may repeat: a line that is not the wanted one is left out
    found = split.select(F.inline(got)).where("xxhash64(line) = k AND xxhash64(line, 1) = k2")
    return found.select("no", "line")


def _groups(lines: DataFrame, edits: int, least: int, words: tuple[int, ...]) -> DataFrame:
    """(sig, no, own, place) of lines (no, line) that meet others at a signature.

    A line's own segments are among the substrings that it probes, so that one row tells both: own
    marks the segments. Rows of a signature that no line owns, or that just one line has, are left
    out; place counts the others from 1 in the order of no. There is one row per line and signature,
    however many lines a signature has.
    """
    cut, plan, sig = with_cuts(lines, edits, least), _char_plan(edits), _char_signature(edits)
    if words:
        cut = _with_words(cut, words)
        plan, sig = f"concat({plan}, {_word_band_plans(words)})", f"if(t < 0, {sig}, {_word_band_signature(words)})"
    # one row for each signature before it is made: one expression, with no lambda, makes all of them
    made = cut.select("*", F.expr(f"inline_outer({plan})"))
    rows = made.select(F.expr(sig).alias("sig"), F.expr("shiftleft(no, 1) | CAST(s = 0 AND d = 0 AS BIGINT)").alias("code"))
    # dealt by signature once: both sides of the join read the same shuffle, and few signatures are left
    rows = rows.repartition("sig")
    shared = rows.groupBy("sig").agg(
        F.max(F.expr("code & 1")).alias("owned"), F.min("code").alias("first"), F.max("code").alias("last")
    ).where("owned = 1 AND shiftright(first, 1) < shiftright(last, 1)")
    # no semi join: it would be pushed below the repartition, and all signatures be made and dealt twice
    rows = rows.join(shared.select("sig").hint("shuffle_hash"), "sig")
    place = F.row_number().over(Window.partitionBy("sig").orderBy("code"))
    return rows.select("sig", F.expr("shiftright(code, 1) AS no"), F.expr("code & 1 = 1 AS own"), place.alias("place"))


def _sketches(texts: DataFrame, words: tuple[int, ...]) -> DataFrame:
    """(no, c, v, t): parities of a line's characters and words by 64 hash buckets, words it may differ in.

    An edit changes two parities at most, so that near lines differ in few of them.
    """
    parity = "aggregate({}, 0L, (s, x) -> s ^ shiftleft(1L, CAST(pmod({}, 64) AS INT)))"
    found = texts.withColumn("w", _word_hashes("line"))
    return found.select(
        "no", F.expr(parity.format("split(line, '')", "xxhash64(x)")).alias("c"),
        F.expr(parity.format("w", "x")).alias("v"), F.expr(_allowed("size(w)", words) if words else "0").alias("t"),
    )


def _later_of_near(groups: DataFrame, texts: DataFrame, edits: int, words: tuple[int, ...]) -> DataFrame:
    """(no) of the lines that are near an earlier one of a common signature.

    Every group compares its lines with its two earliest ones, those not found near yet with the
    next six, and so on, four times as many each time: in a group of variants of one line most are
    settled by the first ones. Pairs whose sketches differ too much are left out where they meet.
    """
    spark = groups.sparkSession
    members = kept_table(join_few(groups, kept_table(_sketches(texts, words), "sketches"), "no"), "members")
    most = members.agg(F.max("place")).first()[0] or 0
    found = kept_table(members.select("no").limit(0), "near")
    low, high = 0, 2
    while low < most:
        hubs = members.where(F.col("place").between(low + 1, high)).selectExpr(
            "sig", "no AS earlier", "own AS own_a", "c AS c_a", "v AS v_a", "t AS t_a"
        )
        rest = join_few(members, found, "no", "left_anti").selectExpr(
            "sig", "no AS later", "own AS own_b", "c AS c_b", "v AS v_b", "t AS t_b"
        )
        by_chars, by_words = f"bit_count(c_a ^ c_b) <= {2 * edits}", "bit_count(v_a ^ v_b) <= 2 * least(t_a, t_b)"
        may_be_near = F.expr(f"earlier < later AND (own_a OR own_b) AND ({by_chars} OR {by_words})")
        met = hubs.join(rest, (hubs["sig"] == rest["sig"]) & may_be_near)
        pairs = met.select(
            "earlier", "later", F.expr(by_chars).alias("by_chars"), F.expr(by_words).alias("by_words")
        ).distinct()
        both = pairs.join(texts.selectExpr("no AS earlier", "line AS line_a"), "earlier").join(
            texts.selectExpr("no AS later", "line AS line_b"), "later"
        )
        # few bytes but much work a pair: dealt over as many tasks as the session shuffles to
        both = both.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "earlier", "later")
        # written before it is filtered: a filter would be pushed into the distance and repeat it
        told = kept_table(near_lines(both, edits, words).select("later", "alike"), "told")
        found = kept_table(found.union(told.where("alike").selectExpr("later AS no").distinct()), "near")
        low, high = high, 4 * high
    return found


def near_lines(pairs: DataFrame, edits: int, words: tuple[int, ...]) -> DataFrame:
    """Add `alike` to pairs (line_a, line_b, by_chars, by_words, ...): within `edits` edits, or in words as allowed.

    by_chars and by_words tell which of the two is possible; the other is not computed.
    """
    keep = [c for c in pairs.columns if c not in ("line_a", "line_b")]
    told = edit_distance(pairs, "line_a", "line_b", edits, "by_chars")
    if not words:
        return told.select(*keep, (F.col("distance") <= edits).alias("alike"))
    most = len(words)
    told = told.select(*keep, "distance", _word_hashes("line_a").alias("u"), _word_hashes("line_b").alias("v"))
    told = told.select(
        *keep, "distance",
        F.expr("if(size(u) >= size(v), u, v)").alias("x"), F.expr("if(size(u) >= size(v), v, u)").alias("y"),
    )
    return told.select(
        *keep,
        F.expr(
            f"CASE WHEN distance <= {edits} THEN true "
            f"WHEN NOT by_words OR size(y) < {words[0]} OR size(x) - size(y) > {most} THEN false "
            f"WHEN size(y) > 32 AND {_banded(most, 32)} > {2 * most} THEN false "
            f"ELSE {_banded(most)} <= {_allowed('size(y)', words)} END"
        ).alias("alike"),
    )


def duplicate_lines(
    docs: DataFrame, *, edits: int = 2, least: int = 20, words: tuple[int, ...] = (), short: bool = False
) -> DataFrame:
    """(doc_id, line_no, kind) of every line of docs (doc_id, text) that repeats an earlier one.

    Lines are what stands between \\n; of those of fewer than ``least`` characters only exact repeats
    count, and only with ``short``; empty lines never do.
    Lines are ordered by doc_id (NULL first) and line number. kind is 'exact' if an equal line comes
    earlier, and 'near' for the first occurrence of a line whose text is within ``edits`` edits of
    another one that occurs earlier, or within t word edits (a word more, less or another; white
    space does not count) where the shorter of both has at least words[t - 1] words, t at most the
    length of ``words``. All other occurrences of such a line are 'exact'. NULL and
    empty texts have no lines that count. Rows with the same doc_id and line number are treated
    alike. An empty table gives an empty result; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    places = _lines(docs, 1 if short else least).select(
        *_keys(), "doc_id", "line_no", (F.length("line") >= least).alias("long")
    )
    firsts = places.groupBy("k", "k2").agg(
        F.min(F.struct("doc_id", "line_no")).alias("at"), F.count("*").alias("copies"),
        F.max("long").alias("long"),
    )
    # numbers in the order of the lines; they are drawn once, for the table is written
    firsts = kept_table(
        firsts.orderBy("at", "k", "k2").withColumn("no", F.monotonically_increasing_id()), "lines"
    )
    places = places.drop("long")
    distinct = _text_of(docs, firsts.where("long"), few=False)
    groups = kept_table(_groups(distinct, edits, least, words), "groups")
    names = kept_table(groups.select("no").distinct(), "names")
    wanted = join_few(firsts.select("no", "k", "k2", "at"), names, "no")
    texts = kept_table(_text_of(docs, wanted, few=True).dropDuplicates(["no"]), "texts")
    near = _later_of_near(groups, texts, edits, words)
    special = join_few(firsts.drop("long"), near.withColumn("near", F.lit(True)), "no", "left").where(
        "copies > 1 OR near"
    )
    found = places.join(special, ["k", "k2"])
    is_first = F.struct("doc_id", "line_no") == F.col("at")
    return found.select(
        "doc_id",
        "line_no",
        F.when(~is_first, "exact").when(F.col("near"), "near").alias("kind"),
    ).where("kind IS NOT NULL")


def line_report(
    docs: DataFrame, *, edits: int = 2, least: int = 20, words: tuple[int, ...] = WORDS
) -> DataFrame:
    """(doc_id, n_lines, n_exact, n_near, removed) per doc_id: counts and the numbers of its lines.

    Exact repeats of lines of fewer than ``least`` characters are counted and listed too.
    Rows that share a doc_id are one document here, n_lines is that of the longest.
    """
    lines = docs.groupBy("doc_id").agg(
        F.max(F.size(F.split(F.coalesce("text", F.lit("")), "\n"))).cast("long").alias("n_lines")
    )
    found = duplicate_lines(docs, edits=edits, least=least, words=words, short=True)
    found = found.groupBy(F.col("doc_id").alias("id")).agg(
        F.count_if(F.col("kind") == "exact").alias("n_exact"),
        F.count_if(F.col("kind") == "near").alias("n_near"),
        F.sort_array(F.collect_set("line_no")).alias("removed"),
    )
    joined = lines.join(found, F.col("doc_id").eqNullSafe(F.col("id")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        "doc_id",
        "n_lines",
        F.coalesce("n_exact", zero).alias("n_exact"),
        F.coalesce("n_near", zero).alias("n_near"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def _origins(docs: DataFrame) -> DataFrame:
    """(t, t2, origin) of every text that several doc_ids have: the least of them, NULL first."""
    texts = docs.select(
        F.xxhash64("text").alias("t"), F.xxhash64("text", F.lit(1)).alias("t2"), F.struct("doc_id").alias("id")
    ).where("text IS NOT NULL")
    return (
        texts.groupBy("t", "t2").agg(F.min("id").alias("origin"), F.max("id").alias("last"))
        .where("origin <> last").select("t", "t2", "origin")
    )


def _gone_by_id(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(id, lists) of found (id, gone): per doc_id the lists (t, t2, gone) of line numbers that its rows lose.

    Rows whose text is that of an earlier doc_id have the earlier one's list, marked with the hashes
    of the text; t is NULL in the list of the others.
    """
    ids = docs.select(
        F.xxhash64("text").alias("t"), F.xxhash64("text", F.lit(1)).alias("t2"), F.struct("doc_id").alias("copy")
    ).where("text IS NOT NULL").distinct()
    copies = join_few(ids, kept_table(_origins(docs), "origins"), ["t", "t2"]).where("copy <> origin")
    copied = copies.join(found, F.col("origin.doc_id").eqNullSafe(F.col("id")), "left").select(
        F.col("copy.doc_id").alias("id"), "t", "t2", "gone"
    )
    unknown = F.lit(None).cast("long")
    every = copied.union(found.select("id", unknown.alias("t"), unknown.alias("t2"), "gone"))
    return every.groupBy("id").agg(F.collect_list(F.struct("t", "t2", "gone")).alias("lists"))


def remove_lines(
    docs: DataFrame, *, edits: int = 2, least: int = 20, words: tuple[int, ...] = WORDS, most: float = 0.5
) -> DataFrame:
    """docs without the lines that repeat earlier ones; all columns and rows stay.

    A document whose text is that of an earlier one loses just the lines that the earlier one loses:
    both stay equal, so that a join of documents finds them. Of any other document every line goes
    that repeats an earlier one, unless more than the share ``most`` of its characters would go;
    with 1 every line decision takes effect. Texts without such a line keep their very bytes.
    """
    found = duplicate_lines(docs, edits=edits, least=least, words=words)
    found = found.groupBy(F.col("doc_id").alias("id")).agg(
        F.collect_set("line_no").alias("gone")
    )
    found = kept_table(_gone_by_id(docs, kept_table(found, "gone")), "by-id")
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.xxhash64("text").alias("t"), F.xxhash64("text", F.lit(1)).alias("t2"),
    )
    # texts are dealt once, by id, whatever their number: the lists would not fit a broadcast for long
    joined = whole.join(found.hint("merge"), F.col("row.doc_id").eqNullSafe(F.col("id")), "left")
    copied = F.filter("lists", lambda x: (x["t"] == F.col("t")) & (x["t2"] == F.col("t2")))
    own = F.filter("lists", lambda x: x["t"].isNull())
    gone = F.get(F.when(F.size(copied) > 0, copied).otherwise(own), F.lit(0))["gone"]
    joined = joined.select("row", gone.alias("gone"))
    lines = F.split(F.col("row.text"), "\n")
    marked = joined.select("row", "gone", lines.alias("lines"))
    left = F.filter("lines", lambda x, i: ~F.array_contains("gone", i))
    short = marked.select("row", "gone", F.array_join(left, "\n").alias("short"))
    cut = F.col("gone").isNotNull() & (
        F.length("short") >= (1 - most) * F.length("row.text")
    )
    text = F.when(cut, F.col("short")).otherwise(F.col("row.text"))
    return short.select(
        *[text.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    )
