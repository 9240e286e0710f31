"""PII surrogates: keyed, type-consistent replacements, checked for collisions.

Entities are found with one pattern. Each has a type and a canonical value (lower case, or digits
only), so that one entity written in two ways is one entity. Its surrogate is drawn from a keyed
hash of type and value, class by class: digits for digits, letters for letters, octets for octets,
syllables with an ending of the same gender and script for names; cards keep their check sum. The
same entity gets the same surrogate everywhere without any lookup. Two entities that would share
one, or a surrogate that is some other entity of the corpus, are found by grouping the candidates;
the losers draw again until all are distinct. Only these exceptions are joined to their documents.
A name found after a form of address is looked up in the rest of its document: its bare mentions
and those of its parts get the matching parts of the same surrogate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.common import join_few, kept_table

# Forms of address by gender.
MALE = "Mr|Herr|Señor|Monsieur|Signor|господин"
FEMALE = "Mrs|Ms|Miss|Frau|Señora|Señorita|Madame|Mme|Signora|госпожа"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Patterns by type, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "phone": r"(?:\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|\(\d{2,5}\) ?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|(?<!\d)(?<!\d[ .-])(?:\d{3}[ .-]\d{3}[ .-]\d{4}|0\d{2,4}[ /-]\d{3,4}[ -]?\d{3,4})(?![ .-]?\d))",
    "card": r"(?<!\d)(?:\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5})(?!\d)",
    "ssn": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|ghp_[0-9A-Za-z]{36})(?![A-Za-z0-9])",
    "hex": r"(?<![A-Za-z0-9])[0-9a-f]{32,64}(?![A-Za-z0-9])",
    "male": rf"(?<!\p{{L}})(?:{MALE})\.? \p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?",
    "female": rf"(?<!\p{{L}})(?:{FEMALE})\.? \p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Syllables and endings of names by script; an index is a hash byte modulo their number.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga ka ke ko la le lo ma me mi mo na ne no pa ra re ro sa ta te to va vo",
    "cyrillic": "ба бе бо да де до фа га ка ке ко ла ле ло ма ме ми мо на не но па ра ре ро са та те то ва во зи",
}
ENDINGS = {"latin": ("n", "na"), "cyrillic": ("н", "на")}


def found_in(text: Column) -> Column:
    """Entities of a text in order, as written."""
    empty = F.array().cast("array<string>")
    found = F.regexp_extract_all(text, F.lit(f"({PATTERN})"), 1)
    # every entity has one of these; other texts are not searched
    hint = text.rlike("[0-9@]|[a-f]{32}")
    for part in f"AKIA|ghp_|{MALE}|{FEMALE}".split("|"):
        hint = hint | text.contains(part)
    return F.when(hint, found).otherwise(empty)


def kind_of(entity: Column) -> Column:
    kinds = [F.when(entity.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in _whole().items()]
    return F.coalesce(*kinds)


def _whole() -> dict[str, str]:
    """The patterns without looks around, for an entity that stands alone."""
    return {
        k: p.replace(r"(?<![\d.])", "").replace(r"(?!\d|\.\d)", "").replace(r"(?<!\d)", "")
        .replace(r"(?!\d)", "").replace("(?<![A-Za-z0-9])", "").replace("(?![A-Za-z0-9])", "")
        .replace(r"(?<!\p{L})", "")
        for k, p in PATTERNS.items()
    }


def value_of(entity: Column, kind: Column) -> Column:
    """Canonical value: what makes two spellings one entity."""
    return (
        F.when(kind == "email", F.lower(entity))
        .when(kind.isin("phone", "card", "ssn"), F.regexp_replace(entity, r"\D", ""))
        .when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .when(kind.isin("male", "female"), F.regexp_replace(entity, rf"^(?:{MALE}|{FEMALE})\.? ", ""))
        .otherwise(entity)
    )


def _stream(key: str, kind: Column, value: Column, attempt: Column, size: Column) -> Column:
    """At least `size` pseudo-random bytes in hexadecimal, a function of key, entity and attempt."""
    label = F.concat_ws("|", F.lit(key), kind, value, attempt.cast("string"))
    part = F.transform(
        F.sequence(F.lit(0), (size / 32).cast("int")),
        lambda i: F.sha2(F.concat_ws("|", label, i.cast("string")).cast("binary"), 256),
    )
    return F.array_join(part, "")


def _luhn(digits: Column) -> Column:
    """Check sum of a string of up to 16 digits, modulo 10."""
    digits = F.lpad(digits, 16, "0")
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(16)),
        F.lit(0),
        lambda total, i: total
        + F.when(
            i % 2 == 1,
            F.substring(digits, i, F.lit(1)).try_cast("int") * 2
            - F.when(F.substring(digits, i, F.lit(1)) >= "5", 9).otherwise(0),
        ).otherwise(F.substring(digits, i, F.lit(1)).try_cast("int")),
    ) % 10


def _byte(stream: str, i: Column) -> Column:
    return F.conv(F.substring(stream, i * 2 + 1, F.lit(2)), 16, 10).cast("int")


def with_surrogate(rows: DataFrame, key: str) -> DataFrame:
    """Add `surrogate` to rows (kind, value, attempt, ...): the canonical value that replaces it."""
    keep = rows.columns
    kind, value = F.col("kind"), F.col("value")
    rows = rows.withColumn("stream_", _stream(key, kind, value, F.col("attempt"), F.length(value) + 8))

    def pick(i: Column, text: str, shift: int = 0) -> Column:
        letters = F.array(*map(F.lit, text.split(" ") if " " in text else list(text)))
        return F.get(letters, _byte("stream_", i + shift) % F.size(letters))

    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # class by class; what must stay (a prefix, the top domain) is left alone
    fixed = (
        F.when(kind == "phone", F.greatest(F.length(value) - 10, F.lit(0)))
        .when((kind == "card") & (F.length(value) == 15), F.lit(2))
        .when((kind == "key") | (kind == "iban"), F.when(kind == "key", 4).otherwise(2))
        .otherwise(0)
    )
    rows = rows.withColumn("fixed_", fixed).withColumn(
        "body_",
        F.when(kind == "email", F.regexp_replace(value, r"\.[a-z]+$", "")).otherwise(value),
    )
    classes = F.array_join(
        F.transform(
            F.filter(F.split("body_", ""), lambda c: c != ""),
            lambda c, i: F.when(i < F.col("fixed_"), c)
            .when((kind == "hex") & c.rlike("[0-9a-f]"), F.substring("stream_", i + 1, F.lit(1)))
            .when(c.rlike("[0-9]"), pick(i, "0123456789"))
            .when(c.rlike("[a-z]"), pick(i, lower))
            .when(c.rlike("[A-Z]"), pick(i, upper))
            .otherwise(c),
        ),
        "",
    )
    octets = F.array_join(
        F.transform(
            F.sequence(F.lit(0), F.lit(3)),
            lambda i: (_byte("stream_", i) % 254 + 1).cast("string"),
        ),
        ".",
    )

    def named(script: str) -> Column:
        end = F.when(kind == "male", ENDINGS[script][0]).otherwise(ENDINGS[script][1])
        return F.array_join(
            F.transform(
                F.split("value", " "),
                lambda part, w: F.concat(
                    F.initcap(
                        F.concat(*[pick(w * 4, SYLLABLES[script], shift) for shift in range(4)])
                    ),
                    F.when(w == 0, end).otherwise(ENDINGS[script][0]),
                ),
            ),
            " ",
        )

    name = F.when(value.rlike(r"^\p{IsCyrillic}"), named("cyrillic")).otherwise(named("latin"))
    drawn = (
        F.when(kind == "ip", octets)
        .when(kind.isin("male", "female"), name)
        .when(kind == "email", F.concat(classes, F.lit(".example")))
        .otherwise(classes)
    )
    rows = rows.withColumn("drawn_", drawn)
    summed = (
        F.substring("drawn_", -1, 1).try_cast("int") + _luhn(value) - _luhn(F.col("drawn_")) + 10
    ) % 10
    card = F.concat(F.expr("left(drawn_, length(drawn_) - 1)"), summed.cast("string"))
    return rows.select(*keep, F.when(kind == "card", card).otherwise(F.col("drawn_")).alias("surrogate"))


def exceptions(entities: DataFrame, key: str, rounds: int = 50) -> DataFrame:
    """(kind, value, attempt) of the entities whose first surrogate is taken.

    entities: distinct (kind, value). A surrogate belongs to the entity that drew it in the
    earliest attempt, of those to the smallest value; nobody gets one that is itself an entity.
    """
    state = kept_table(entities.withColumn("attempt", F.lit(0)), "entities")
    for _ in range(rounds):
        drawn = kept_table(with_surrogate(state, key), "drawn")
        owner = drawn.groupBy("kind", "surrogate").agg(
            F.min(F.struct("attempt", "value")).alias("owner"), F.count("*").alias("n")
        )
        clash = owner.where("n > 1").select("kind", "surrogate", F.col("owner.value").alias("winner"))
        real = entities.select("kind", F.col("value").alias("surrogate"))
        real = owner.select("kind", "surrogate").join(real, ["kind", "surrogate"], "left_semi")
        blocked = kept_table(
            clash.unionByName(real.withColumn("winner", F.lit(None).cast("string")))
            .groupBy("kind", "surrogate")
            .agg(F.count_if(F.col("winner").isNull()).alias("taken"), F.max("winner").alias("winner")),
            "blocked",
        )
        if blocked.isEmpty():
            break
        lost = F.col("taken").isNotNull() & (
            (F.col("taken") > 0) | ~F.col("winner").eqNullSafe(F.col("value"))
        )
        state = kept_table(
            join_few(drawn, blocked, ["kind", "surrogate"], "left").select(
                "kind", "value", (F.col("attempt") + lost.cast("int")).alias("attempt")
            ),
            "entities",
        )
    else:
        raise RuntimeError(f"surrogates did not become distinct in {rounds} rounds.")
    return state.where("attempt > 0")


def _written(entity: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the form in which the entity was written."""
    chars = F.filter(F.split(entity, ""), lambda c: c != "")
    spread = F.array_join(
        F.transform(
            chars,
            lambda c, i: F.when(
                c.rlike("[0-9A-Z]"),
                F.substring(
                    surrogate,
                    F.length(F.regexp_replace(F.substring(entity, F.lit(1), i + 1), "[^0-9A-Z]", "")),
                    F.lit(1),
                ),
            ).otherwise(c),
        ),
        "",
    )
    address = F.regexp_extract(entity, rf"^(?:{MALE}|{FEMALE})\.? ", 0)
    return (
        F.when(kind.isin("phone", "card", "ssn", "iban"), spread)
        .when(kind.isin("male", "female"), F.concat(address, surrogate))
        .when((kind == "email") & (entity == F.upper(entity)), F.upper(surrogate))
        .otherwise(surrogate)
    )


def _entities(docs: DataFrame) -> DataFrame:
    """(doc_id, version, entity, kind, value) of every distinct entity of every text."""
    rows = docs.select(
        "doc_id",
        F.xxhash64("text").alias("version"),
        F.explode(F.array_distinct(found_in(F.col("text")))).alias("entity"),
    )
    rows = rows.withColumn("kind", kind_of(F.col("entity")))
    return rows.withColumn("value", value_of(F.col("entity"), F.col("kind")))


def _mentions(maps: DataFrame) -> DataFrame:
    """maps (id, v, found, entity_kinds) with `told` and `pattern` in place of found.

    told leads from what the pattern finds in the text to its surrogate. A single name after a form
    of address belongs to the full name of that gender that has it as a part, a bare mention to the
    name itself, else to a full name, else to a single one; of several the least is taken.
    """
    names = F.array_sort(
        F.array_distinct(
            F.transform(
                F.filter("found", lambda x: x["kind"].isin("male", "female")),
                lambda x: F.struct(x["value"].alias("value"), x["kind"].alias("kind"), x["surrogate"].alias("surrogate")),
            )
        )
    )
    maps = maps.withColumn("names", names)
    parts = F.expr(
        "flatten(transform(filter(names, x -> contains(x.value, ' ')), x -> transform(split(x.value, ' '), (p, i) -> "
        "named_struct('value', p, 'kind', x.kind, 'surrogate', split(x.surrogate, ' ')[i]))))"
    )
    maps = maps.withColumn("parts", parts)
    # the first of a spelling counts
    maps = maps.withColumn(
        "bare", F.expr("concat(filter(names, x -> contains(x.value, ' ')), parts, names)")
    ).withColumn("spelt", F.expr("array_distinct(transform(bare, x -> x.value))"))
    address = rf"^(?:{MALE}|{FEMALE})\.? "

    def written(x: Column) -> Column:
        whole = F.filter("parts", lambda p: (p["kind"] == x["kind"]) & (p["value"] == x["value"]))
        same = F.get(whole, F.lit(0))["surrogate"]
        return F.coalesce(F.concat(F.regexp_extract(x["entity"], address, 0), same), x["written"])

    entities = F.transform("found", lambda x: F.struct(x["entity"].alias("entity"), written(x).alias("new")))
    bare = F.transform(
        "spelt",
        lambda v: F.struct(
            v.alias("entity"),
            F.get(F.filter("bare", lambda x: x["value"] == v), F.lit(0))["surrogate"].alias("new"),
        ),
    )
    # longer spellings are tried first; they are letters and spaces only
    ordered = F.expr("array_join(transform(array_sort(transform(spelt, x -> named_struct('n', -length(x), 'x', x))), y -> y.x), '|')")
    pattern = F.when(
        F.size("spelt") > 0,
        F.concat(F.lit(PATTERN + r"|(?<!\p{L})(?:"), ordered, F.lit(r")(?!\p{L})")),
    ).otherwise(PATTERN)
    return maps.select(
        "id", "v", "entity_kinds", F.map_from_entries(F.concat(entities, bare)).alias("told"), pattern.alias("pattern")
    )


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """docs with surrogates in `text` and two columns more: n_entities and entity_kinds.

    Every occurrence of an entity is replaced; the rest of the text stays as it is. Distinct
    entities of a kind get distinct surrogates, none of which is an entity of the corpus, and the
    same entity gets the same one in every row. Inside a document this also holds for bare mentions of
    a name, for its parts and for a single name that is part of a full one of the same gender (see
    _mentions); such a mention counts as an entity. NULL texts stay NULL with no entity, empty texts and
    tables stay empty, repeated rows and NULL ids are treated like any other; other columns of docs
    (but for these two names, which are replaced) are kept.
    """
    seen = kept_table(_entities(docs.select("doc_id", "text")), "found")
    distinct = kept_table(seen.select("kind", "value").distinct(), "distinct")
    taken = kept_table(exceptions(distinct, key), "exceptions")
    told = join_few(seen, taken, ["kind", "value"], "left").withColumn(
        "attempt", F.coalesce("attempt", F.lit(0))
    )
    told = with_surrogate(told, key).withColumn(
        "written", _written(F.col("entity"), F.col("kind"), F.col("surrogate"))
    )
    grouped = told.groupBy(F.col("doc_id").alias("id"), F.col("version").alias("v")).agg(
        F.collect_set(F.struct("entity", "kind", "value", "surrogate", "written")).alias("found"),
        F.sort_array(F.collect_set("kind")).alias("entity_kinds"),
    )
    maps = kept_table(_mentions(grouped), "surrogates")
    names = [c for c in docs.columns if c not in ("n_entities", "entity_kinds")]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("row.text") == F.col("v"))
    rows = join_few(whole, maps, same, "left")
    # the same pattern gives the entities and, as a separator, what stands between them
    found = F.expr("regexp_extract_all(row.text, concat('(', pattern, ')'), 1)")
    rows = rows.select("row", "told", "pattern", "entity_kinds", F.when(F.col("told").isNotNull(), found).alias("e"))
    pieces = F.zip_with(
        F.split("row.text", F.col("pattern"), -1),
        F.transform("e", lambda x: F.element_at("told", x)),
        lambda between, new: F.concat(between, F.coalesce(new, F.lit(""))),
    )
    text = F.when(F.size("e") > 0, F.array_join(pieces, "")).otherwise(F.col("row.text"))
    return rows.select(
        *[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in names],
        F.coalesce(F.size("e"), F.lit(0)).cast("long").alias("n_entities"),
        F.coalesce("entity_kinds", F.array().cast("array<string>")).alias("entity_kinds"),
    )
