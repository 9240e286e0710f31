import random
from collections import Counter

from sparkfold.llm import common, line_dedup as ld


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(draw, text, n):
    chars = list(text)
    for _ in range(n):
        at = draw.randrange(len(chars) + 1)
        kind = draw.randrange(3)
        if kind == 0:
            chars.insert(at, draw.choice("abé"))
        elif chars and kind == 1:
            chars.pop(min(at, len(chars) - 1))
        elif chars:
            chars[min(at, len(chars) - 1)] = draw.choice("abé")
    return "".join(chars)


def test_distance(spark):
    draw = random.Random(2)
    rows = []
    for _ in range(600):
        a = "".join(draw.choices("abé", k=draw.randrange(0, 90)))
        rows.append((a, edited(draw, a, draw.randrange(5)), 1))
    rows += [("", "", 1), ("", "ab", 1), ("abc", "", 1), ("a", "b", 1), ("ab" * 300, "ab" * 300 + "c", 1)]
    df = spark.createDataFrame(rows, "a string, b string, z int")
    for edits in (1, 2, 3):
        for r in ld.edit_distance(df, "a", "b", edits).collect():
            assert r.distance == min(distance(r.a, r.b), edits + 1), (r, edits)


def brute(docs, edits, least, words=()):
    """Every line that repeats an earlier one: exactly, within edits, or in as many words as allowed."""
    places, out = {}, []
    for d, text in docs:
        for i, line in enumerate((text or "").split("\n")):
            if len(line) >= least:
                places.setdefault(line, []).append((d is not None, d, i))
    first = {x: min(at) for x, at in places.items()}
    cut = {x: x.split() for x in places}

    def alike(x, y):
        if abs(len(x) - len(y)) <= edits and distance(x, y) <= edits:
            return True
        n, m = sorted((len(cut[x]), len(cut[y])))
        allowed = sum(n >= w for w in words)
        # words in common, counted, are at least what so many edits leave
        if not allowed or m - n > allowed or (Counter(cut[x]) & Counter(cut[y])).total() < m - allowed:
            return False
        return distance(cut[x], cut[y]) <= allowed

    near = {x for x in places for y in places if first[y] < first[x] and alike(x, y)}
    for line, at in places.items():
        for p in set(at):
            if p != first[line]:
                out.append((*p[1:], "exact"))
            elif line in near:
                out.append((*p[1:], "near"))
    return sorted(out, key=str)


def make(draw, n):
    base = ["".join(draw.choices("abcdé ", k=draw.randrange(6, 60))) for _ in range(25)]
    return [
        (d, "\n".join(edited(draw, draw.choice(base), draw.choice([0, 0, 1, 2, 3])) for _ in range(draw.randrange(6))))
        for d in range(n)
    ]


def test_against_brute_force(spark):
    draw = random.Random(4)
    docs = make(draw, 70) + [(100, None), (101, ""), (102, "\n\n"), (None, "x" * 50 + "\nshort"), (103, "x" * 51)]
    docs += [(104, "y" * 3000 + "\n" + "y" * 3001)]
    df = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, k int")
    for edits, least in ((1, 8), (2, 20)):
        got = ld.duplicate_lines(df, edits=edits, least=least).collect()
        assert sorted(map(tuple, got), key=str) == brute(docs, edits, least)
    assert ld.duplicate_lines(df.limit(0)).count() == 0
    report = {r.doc_id: r for r in ld.line_report(df).collect()}
    assert len(report) == len(docs) and report[101].n_lines == 1 and report[103].n_near == 1


def test_removal(spark):
    line, other = "a line that many documents have", "something else that stands alone here"
    docs = [(1, f"{line}\n{other}", "p"), (2, f"{line}!\n{other * 2}", "q"), (3, line, "r"), (4, None, "s"), (5, "", "t")]
    df = spark.createDataFrame(docs, "doc_id long, text string, gone string")
    out = ld.remove_lines(df)
    assert out.columns == df.columns
    rows = {r.doc_id: r.text for r in out.collect()}
    assert rows == {1: docs[0][1], 2: other * 2, 3: line, 4: None, 5: ""}


def words_apart(a, b):
    return distance(a.split(), b.split())


def test_threshold_grows_with_the_words(spark):
    draw = random.Random(6)
    bands, lines = (4, 9, 15), []
    for _ in range(12):
        base = [f"word{draw.randrange(400)}" for _ in range(draw.randrange(3, 20))]
        for _ in range(5):
            words = list(base)
            for _ in range(draw.randrange(4)):
                at, kind = draw.randrange(len(words)), draw.randrange(3)
                words[at : at + (kind != 0)] = [f"another{draw.randrange(10**6)}"][: kind != 1]
            lines.append(" ".join(words))
    lines += [lines[0].replace(" ", "  "), "x " * 40 + "first", "x " * 40 + "second", "no", "no", "", ""]
    docs = list(enumerate(lines))
    first = {}
    for d, x in docs:
        first.setdefault(x, d)
    want = [(d, 0, "exact") for d, x in docs if x and first[x] != d]
    for x in first:
        for y in first:
            allowed = sum(min(len(x.split()), len(y.split())) >= n for n in bands)
            near = distance(x, y) <= 2 or allowed and words_apart(x, y) <= allowed
            if first[y] < first[x] and min(len(x), len(y)) >= 20 and near:
                want.append((first[x], 0, "near"))
                break
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = ld.duplicate_lines(df, words=bands, short=True)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(k == "near" for *_, k in want) > 15


def test_report_of_a_changed_word_and_short_lines(spark):
    line = "one line that differs in a single word from another line"
    docs = [(1, f"{line}\nend"), (2, line.replace("differs", "departs greatly")[:-5]), (3, line.replace("single", "different") + "\nend")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    report = {r.doc_id: (r.n_exact, r.n_near, r.removed) for r in ld.line_report(df).collect()}
    assert report == {1: (0, 0, []), 2: (0, 0, []), 3: (1, 1, [0, 1])}
    assert {r.doc_id: r.text for r in ld.remove_lines(df, most=1.0).collect()}[3] == "end"


def test_groups_with_a_common_head_make_no_squares(spark, monkeypatch):
    draw = random.Random(8)
    head, near = "one head that all lines of the group share ", "the tail that most of them vary a little"
    lines = [head + "".join(draw.choices("abcdefghijklmnop", k=40)) for _ in range(45)]
    lines += [edited(draw, head + near, draw.choice([1, 2, 3, 4])) for _ in range(75)]
    draw.shuffle(lines)
    docs, seen, verify = list(enumerate(lines)), [], ld.near_lines

    def counted(pairs, *rest):
        seen.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(ld, "near_lines", counted)
    got = ld.duplicate_lines(spark.createDataFrame(docs, "doc_id long, text string"), edits=2, least=20)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, 2, 20)
    assert len(seen) > 2 and sum(seen) < 1500  # of 7,140 pairs


def test_word_plan_is_whole_and_only_what_a_line_has(spark):
    words = (4, 9, 15)
    for m in range(40):
        want = set()
        for s in range(4):
            t = sum(m - s >= least for least in words)
            want |= {
                (t, s, i, d) for i in range(t + 1) for d in range(-i, i + 1)
                if t and s <= t and s - (t - i) <= d <= s + (t - i)
            }
        plan = ld._word_plan(m, words)
        t = sum(m >= least for least in words)
        assert len(plan) == len(set(plan)) and set(plan) == want
        assert plan[: t + 1 if t else 0] == [(t, 0, i, 0) for i in range(t + 1 if t else 0)]
    df = spark.createDataFrame([(list(range(m)),) for m in range(40)], "w array<long>").selectExpr("w", "size(w) AS m")
    for r in df.select("m", ld.word_signatures(words).alias("s")).collect():
        assert len(r.s) == len(ld._word_plan(r.m, words))


def test_a_distance_known_to_be_more_is_not_computed(spark):
    df = spark.createDataFrame([("abcd", "abce", True), ("abcd", "abce", False)], "a string, b string, may boolean")
    assert [r.distance for r in ld.edit_distance(df, "a", "b", 2, "may").orderBy("may").collect()] == [3, 1]


def test_bands_of_lengths_lose_no_pair_and_need_few_signatures(spark):
    draw, lines = random.Random(9), []
    for n in [*range(20, 30), *range(58, 76)]:
        base = "".join(draw.choices("abcdé ", k=n))
        lines += [base, *(edited(draw, base, k) for k in (1, 2, 3, 3, 4))]
    docs = list(enumerate(lines))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for edits in (2, 3):
        assert sorted(map(tuple, ld.duplicate_lines(df, edits=edits).collect()), key=str) == brute(docs, edits, 20)
    cut = ld.with_cuts(spark.createDataFrame([("x" * n,) for n in range(20, 200)], "line string"), 2, 20)
    made = {r.n: r.k for r in cut.selectExpr("n", f"size({ld._char_plan(2)}) AS k").collect()}
    # 12 before, for each line; now twice as many as 5 where a shorter line may be in the band below
    assert set(made.values()) == {5, 10} and made[20] == made[21] == 5 and made[24] == made[25] == 10 and made[26] == 5
    assert sum(made.values()) < 7 * len(made)


def test_bands_of_word_numbers_lose_no_pair_and_need_few_signatures(spark):
    draw, words, lines = random.Random(11), (3, 8, 19), []
    for n in range(7, 40):
        base = [f"w{draw.randrange(60)}" for _ in range(n)]
        lines.append(" ".join(base))
        for k in (1, 2, 3, 4):
            line = list(base)
            for _ in range(k):
                at, kind = draw.randrange(len(line)), draw.randrange(3)
                line[at : at + (kind != 0)] = [f"another{draw.randrange(10**6)}"][: kind != 1]
            lines.append(" ".join(line))
    draw.shuffle(lines)
    docs = list(enumerate(lines))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = ld.duplicate_lines(df, words=words).collect()
    want = brute(docs, 2, 20, words)
    assert sorted(map(tuple, got), key=str) == want and len(want) > 60
    cut = ld._with_words(spark.createDataFrame([("x " * m,) for m in range(200)], "line string"), ld.WORDS)
    made = {r.m: r.k for r in cut.selectExpr("m", f"size({ld._word_band_plans(ld.WORDS)}) AS k").collect()}
    assert all(made[m] == len(ld._word_plan(m, ld.WORDS)) for m in range(40))
    # 12 and 26 before, for each line
    assert {made[m] for m in range(42, 80)} == {5, 10} and {made[m] for m in range(83, 200)} == {8, 16}
    assert made[40] == 7 and made[41] == 5 and made[80] == 13 and made[82] == 8


def test_removal_deals_the_texts_once(spark, monkeypatch):
    line, other = "a line that many documents have", "something else that stands alone here"
    docs = [(1, f"{line}\n{other}"), (None, line), (2, f"{line}\n{other}"), (3, f"{other}\nno line like this one here"), (3, line)]
    docs += [(4, None), (5, None), (6, f"{line}\n{other}")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = ld.remove_lines(df, most=1.0).collect()
    # as with many documents: no table is small enough for a broadcast
    monkeypatch.setattr(common, "FEW_ROWS", -1)
    out = ld.remove_lines(df, most=1.0)
    # before, the texts were dealt a second time, by what they are copies of
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 2
    rows = sorted(map(tuple, out.collect()), key=str)
    assert rows == sorted(map(tuple, want), key=str)
    # copies of 1 lose what 1 loses, a copy of the first document nothing
    assert rows == sorted([(1, other), (2, other), (6, other), (None, line), (4, None), (5, None), (3, "no line like this one here"), (3, line)], key=str)
