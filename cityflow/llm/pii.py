"""Surrogates for personal data and secrets, in DataFrame functions only.

One expression finds mentions. Distinct mentions are reduced to canonical parts (digits of a
number, lower-case address, words of a name), so that every mention of a thing gets the same
surrogate in the whole corpus. A name is found by the form of address before it; its words then
count wherever they stand in the same text, capitalised and as whole words. A surrogate is drawn from a keyed hash and keeps the type,
length, letter case, script, gender and check digits of what it replaces. Draws that meet
another surrogate or a real value are drawn again, so different things stay different.
Texts without mentions are passed through as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import saved

KEY = "replace-this-key"
DRAWS = 40

# Labels of secrets, forms of address by gender, and the shape of each type.
# What may be long ends in a possessive repetition: nothing of it stays behind, in linear time.
LABEL = (
    r"(?:[Pp]assword|PASSWORD|passwd|pwd|[Ss]ecret|SECRET|[Tt]oken|TOKEN|api[_-]?key|API[_-]?KEY)"
    r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
)
MALE = r"(?:Mr|Herr|Monsieur|Señor|Sr|Signor|г-н|господин|κύριος)"
FEMALE = r"(?:Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Signora|г-жа|госпожа|κυρία)"
NEUTRAL = r"(?:Dr|Prof)"
# a hyphen or an apostrophe inside a word, but not the 's of a genitive
NAME_WORD = r"\p{Lu}(?:\p{L}|['-](?=\p{L})(?!s(?!\p{L})))++"
WORD = r"(?<![\p{L}\p{N}_])" + NAME_WORD + r"(?![\p{L}\p{N}_])"
TYPES = {
    "secret": LABEL + r"[^\s\"']{6,}+",
    # a run of these characters is tried as a whole at its start, elsewhere to a bound; the last
    # choice of a domain serves one whose last labels are no letters
    "email": (
        r"(?:(?<![._%+-])[A-Za-z0-9._%+-]++|(?<=[._%+-])[A-Za-z0-9._%+-]{1,64}+)@"
        r"(?:(?:[A-Za-z0-9-]++\.(?=[A-Za-z]{2}|[A-Za-z0-9-]++\.))++[A-Za-z]{2,}+"
        r"|(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,}+)"
    ),
    "key": (
        r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])|gh[pousr]_[0-9A-Za-z]{36,}+"
        r"|sk-[0-9A-Za-z_-]{20,}+"
    ),
    # 15 characters at least
    "iban": (
        r"[A-Z]{2}[0-9]{2}(?:(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?"
        r"|(?: ?[A-Z0-9]{4}){2} ?[A-Z0-9]{3})(?![A-Za-z0-9])"
    ),
    "ip": (
        r"(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}"
        r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9])"
    ),
    "card": (
        r"(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|3[0-9]{3}[ -][0-9]{6}[ -][0-9]{5})"
        r"(?![0-9])"
    ),
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])",
    "phone": (
        r"(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})[ .-]?[0-9]{2,4}[ .-]?[0-9]{2,4}"
        r"(?:[ .-]?[0-9]{2,4}){0,5}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}"
        r"|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9])"
    ),
    "name": rf"(?:{MALE}|{FEMALE}|{NEUTRAL})\.? {NAME_WORD}(?: {NAME_WORD}){{0,2}}",
}
MENTION = r"(?<![A-Za-z0-9])(?:" + "|".join(TYPES.values()) + ")"
SYLLABLES = {
    "latin": "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo zu",
    "cyrillic": "ба ве ги до жу за ке ли мо ну па ре си то фу ха це чи шо юл",
    "greek": "βα γε δι ζο θυ κα λε μι νο ξυ πα ρε σι το φυ χα ψε βι γο δυ",
}
ENDINGS = {
    "latin": {"m": "n", "f": "na", "n": "l"},
    "cyrillic": {"m": "н", "f": "на", "n": "ль"},
    "greek": {"m": "ος", "f": "να", "n": "λ"},
}


def mentions(text: Column) -> Column:
    """All mentions in a text, in order; null for a null text."""
    return F.regexp_extract_all(text, F.lit(MENTION), F.lit(0))


def _named_again(text: Column, found: Column) -> Column:
    """Whether a word of a name among the mentions stands in the rest of the text as well."""
    named = F.filter(found, lambda m: m.rlike(f"^(?:{TYPES['name']})$"))
    words = F.flatten(F.transform(named, lambda m: _words(_after_title(m), NAME_WORD)))
    rest = F.flatten(F.transform(F.split(text, MENTION, -1), lambda p: _words(p, WORD)))
    return F.when(F.size(words) > 0, F.arrays_overlap(words, rest)).otherwise(F.lit(False))


def _words(text: Column, shape: str) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(shape), F.lit(0)), F.lower)


def _pieces(text: Column, again: Column) -> Column:
    """What stands between tokens: the mentions, and if `again` also the other words that may
    be part of a name."""
    return F.flatten(
        F.transform(
            F.split(text, MENTION, -1),
            lambda p: F.when(again, F.split(p, WORD, -1)).otherwise(F.array(p)),
        )
    )


def _tokens(text: Column, found: Column, again: Column) -> Column:
    """The token behind each of `_pieces`, null behind the last: structs (token, is_mention)."""

    def of(piece: Column, i: Column) -> Column:
        words = F.when(again, F.regexp_extract_all(piece, F.lit(WORD), F.lit(0))).otherwise(
            F.array().cast("array<string>")
        )
        return F.concat(
            F.transform(
                words, lambda w: F.struct(w.alias("token"), F.lit(False).alias("is_mention"))
            ),
            F.array(F.struct(F.get(found, i).alias("token"), F.lit(True).alias("is_mention"))),
        )

    return F.flatten(F.transform(F.split(text, MENTION, -1), of))


def redact(
    docs: DataFrame, key: str = KEY, text_col: str = "text", count_col: str | None = None
) -> DataFrame:
    """`docs` with every mention replaced by its surrogate; all other columns as they are,
    and the number of mentions in `count_col` if that is named.

    Null texts stay null, empty ones empty. Repeated rows get the same surrogates. A mention
    that recurs in a third of all texts is one row of the surrogate table, and the join back
    can be split. An empty table gives an empty table.
    """
    columns = docs.columns
    text = F.col(f"row.{text_col}")
    found = saved(
        docs.select(
            F.monotonically_increasing_id().alias("row_id"),
            F.struct(*[docs[c] for c in columns]).alias("row"),
            mentions(docs[text_col]).alias("mentions"),
        ).withColumn("again", _named_again(text, F.col("mentions"))),
        "op5-found",
    )
    some = F.coalesce(F.size("mentions"), F.lit(0)) > 0
    tokens = _tokens(text, F.col("mentions"), F.col("again"))
    at = (
        found.where(some)
        .select("row_id", "again", F.posexplode(tokens).alias("pos", "t"))
        .select("row_id", "again", "pos", "t.token", "t.is_mention")
        .where("token IS NOT NULL")
    )
    mentioned = at.where("is_mention").withColumnRenamed("token", "mention")
    table, drawn = _surrogates(mentioned.select("mention").distinct(), key)
    # in a text a word has one kind: a given name if it is one anywhere
    named = (
        mentioned.where(F.col("again") & F.col("mention").rlike(f"^(?:{TYPES['name']})$"))
        .select("row_id", F.explode(_parts(F.lit("name"), F.col("mention"))).alias("p"))
        .groupBy("row_id", F.col("p.value").alias("value"))
        .agg(F.min("p.kind").alias("kind"))
        .join(drawn, ["kind", "value"])
        .select("row_id", "value", "drawn")
    )
    words = (
        at.where("NOT is_mention")
        .withColumn("value", F.lower("token"))
        .join(named, ["row_id", "value"], "left")
        .select(
            "row_id", "pos",
            F.coalesce(_cased(F.col("drawn"), F.col("token")), "token").alias("surrogate"),
            F.col("drawn").isNotNull().cast("int").alias("replaced"),
        )
    )
    new = (
        mentioned.join(table, "mention")
        .select("row_id", "pos", "surrogate", F.lit(1).alias("replaced"))
        .union(words)
        .groupBy("row_id")
        .agg(
            F.sort_array(F.collect_list(F.struct("pos", "surrogate"))).alias("new"),
            F.sum("replaced").cast("int").alias("replaced"),
        )
    )
    pieces = _pieces(text, F.col("again"))
    woven = F.concat_ws(
        "",
        F.transform(
            pieces, lambda p, i: F.concat(p, F.coalesce(F.get("new.surrogate", i), F.lit("")))
        ),
    )
    changed = found.where(some).join(new, "row_id").withColumn("text_out", woven)
    same = found.where(~some).withColumn("text_out", text)
    out = []
    for part, n in ((same, F.lit(0)), (changed, F.col("replaced"))):
        kept = [
            F.col("text_out").alias(c) if c == text_col else F.col("row").getField(c).alias(c)
            for c in columns
        ]
        out.append(part.select(*kept, *([n.alias(count_col)] if count_col else [])))
    return out[0].union(out[1])


def _type(mention: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, shape in reversed(TYPES.items()):
        kind = F.when(mention.rlike(f"^(?:{shape})$"), F.lit(name)).otherwise(kind)
    return kind


def _parts(kind: Column, mention: Column) -> Column:
    """The canonical parts of a mention as structs (kind, value)."""
    digits = F.regexp_replace(mention, "[^0-9]", "")
    plain = F.regexp_replace(mention, "[ -]", "")
    value = (
        F.when(kind.isin("card", "ssn", "phone"), digits)
        .when(kind == "iban", plain)
        .when(kind == "email", F.lower(mention))
        .when(kind == "secret", F.regexp_replace(mention, "^" + LABEL, ""))
        .otherwise(mention)
    )
    one = F.array(F.struct(kind.alias("kind"), value.alias("value")))
    names = F.regexp_extract_all(_after_title(mention), F.lit(NAME_WORD), F.lit(0))
    gender = (
        F.when(mention.rlike(rf"^{FEMALE}\.? "), "f")
        .when(mention.rlike(rf"^{MALE}\.? "), "m")
        .otherwise("n")
    )
    words = F.transform(
        names,
        lambda w, i: F.struct(
            F.when(i == F.size(names) - 1, F.lit("surname"))
            .otherwise(F.concat(F.lit("given_"), gender))
            .alias("kind"),
            F.lower(w).alias("value"),
        ),
    )
    return F.when(kind == "name", words).otherwise(one)


def _after_title(mention: Column) -> Column:
    return F.regexp_replace(mention, rf"^(?:{MALE}|{FEMALE}|{NEUTRAL})\.? ", "")


def _surrogates(distinct_mentions: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(mention, surrogate) of every distinct mention; (kind, value, drawn) of their parts."""
    kinds = distinct_mentions.withColumn("type", _type(F.col("mention"))).withColumn(
        "type", F.coalesce("type", F.lit("key"))
    )
    parts = saved(
        kinds.select(
            "mention", "type", F.posexplode(_parts(F.col("type"), F.col("mention"))).alias("at", "p")
        ).select("mention", "type", "at", "p.kind", "p.value"),
        "op5-parts",
    )
    drawn = _distinct_draws(parts.select("kind", "value").distinct(), key)
    gathered = (
        parts.join(drawn, ["kind", "value"])
        .groupBy("mention", "type")
        .agg(F.sort_array(F.collect_list(F.struct("at", "drawn"))).alias("d"))
        .withColumn("d", F.col("d.drawn"))
    )
    table = saved(
        gathered.select("mention", _render(F.col("type"), F.col("mention")).alias("surrogate")),
        "op5-table",
    )
    return table, drawn


def _cased(drawn: Column, original: Column) -> Column:
    """A drawn name in upper case if the original is."""
    upper = (original == F.upper(original)) & (F.length(original) > 1)
    return F.when(upper, F.upper(drawn)).otherwise(F.initcap(drawn))


def _render(kind: Column, mention: Column) -> Column:
    """The drawn parts `d` in the format of the mention."""
    first = F.get("d", F.lit(0))
    chars = F.split(mention, "")

    def put(kept: str) -> Column:
        """Characters of `first` in turn, separators of the mention in their places."""
        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
        return F.aggregate(
            F.filter(chars, lambda c: c != ""),
            start,
            lambda a, c: F.when(
                c.rlike(kept),
                F.struct(
                    F.concat(a["out"], F.substring(first, a["k"], F.lit(1))).alias("out"),
                    (a["k"] + 1).alias("k"),
                ),
            ).otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["k"].alias("k"))),
        )["out"]

    title = F.regexp_extract(mention, rf"^((?:{MALE}|{FEMALE}|{NEUTRAL})\.? )", 1)
    originals = F.regexp_extract_all(_after_title(mention), F.lit(NAME_WORD), F.lit(0))
    cased = F.transform(F.col("d"), lambda w, i: _cased(w, F.get(originals, i)))
    return (
        F.when(kind.isin("card", "ssn", "phone"), put("[0-9]"))
        .when(kind == "iban", put("[A-Z0-9]"))
        .when(kind == "secret", F.concat(F.regexp_extract(mention, "^" + LABEL, 0), first))
        .when(kind == "name", F.concat(title, F.array_join(cased, " ")))
        .when((kind == "email") & (mention == F.upper(mention)), F.upper(first))
        .otherwise(first)
    )


def _distinct_draws(values: DataFrame, key: str) -> DataFrame:
    """(kind, value, drawn): drawn values are distinct within a kind and none is a real value.
    Each round keeps the drawn values that are free, for the first value that drew them; the
    others draw again. What still meets others after DRAWS rounds (a kind with more values
    than forms, which names never are) gets a form of its own with its whole hash."""
    spark = values.sparkSession
    values = saved(values, "op5-values")
    open_, done = values, None
    for attempt in range(DRAWS + 1):
        last = attempt == DRAWS
        drawn = _draw(F.col("kind"), F.col("value"), key, attempt)
        if last:
            drawn = F.concat("kind", F.lit("-"), F.sha2(F.concat_ws("|", F.lit(key), "kind", "value"), 256))
        # few rows in few files, but each is some work: spread them over all tasks
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spread = open_.repartition(parts, "kind", "value")
        tried = saved(spread.withColumn("drawn", drawn), "op5-draws")
        real = values.select("kind", F.col("value").alias("drawn"))
        free = tried if last else tried.join(real, ["kind", "drawn"], "left_anti")
        if done is not None and not last:
            free = free.join(done.select("kind", "drawn"), ["kind", "drawn"], "left_anti")
        kept = free if last else free.groupBy("kind", "drawn").agg(F.min("value").alias("value"))
        kept = saved(kept.select("kind", "value", "drawn"), "op5-kept")
        done = kept if done is None else done.union(kept)
        open_ = saved(
            tried.select("kind", "value").join(kept, ["kind", "value"], "left_anti"), "op5-open"
        )
        if not open_.limit(1).count():
            break
    return done


def _stream(key: str, attempt: int, *parts: Column) -> Column:
    """Blocks of 64 hex digits from a keyed hash, a byte at least for each character of the
    last part. The blocks of a long value come from its hash, so the time stays linear."""
    size = F.length(parts[-1])
    seed = F.concat_ws("|", F.lit(key), F.lit(str(attempt)), *parts)
    seed = F.when(size > 128, F.sha2(seed, 256)).otherwise(seed)
    blocks = F.sequence(F.lit(0), F.greatest(F.lit(3), F.floor(size / 32).cast("int")))
    return _let(
        seed,
        lambda s: F.transform(blocks, lambda k: F.sha2(F.concat_ws("|", s, k.cast("string")), 256)),
    )


def _number(stream: Column, i: Column) -> Column:
    """The i-th byte of a stream."""
    block = F.get(stream, F.floor(i / 32).cast("int"))
    return F.conv(F.substring(block, (i % 32) * 2 + F.lit(1), F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, n: Column) -> Column:
    return F.substring(F.lit(letters), n % len(letters) + F.lit(1), F.lit(1))


def _alike(value: Column, stream: Column) -> Column:
    """Each character by one of its kind: digit, hexadecimal digit of a hexadecimal value,
    lower or upper letter; others stay."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def drawn(hexadecimal: Column) -> Column:
        return F.transform(
            F.filter(F.split(value, ""), lambda c: c != ""),
            lambda c, i: F.when(hexadecimal, _pick("0123456789abcdef", _number(stream, i)))
            .when(c.rlike("[0-9]"), _pick("0123456789", _number(stream, i)))
            .when(c.rlike("[a-z]"), _pick(upper.lower(), _number(stream, i)))
            .when(c.rlike("[A-Z]"), _pick(upper, _number(stream, i)))
            .otherwise(c),
        )

    return F.concat_ws("", _let(value.rlike("^(?=.*[a-f])[0-9a-f]{8,}$"), drawn))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, not again for every character."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _draw(kind: Column, value: Column, key: str, attempt: int) -> Column:
    return _let(
        _stream(key, attempt, kind, value), lambda stream: _drawn(kind, value, stream, key, attempt)
    )


def _drawn(kind: Column, value: Column, stream: Column, key: str, attempt: int) -> Column:
    alike = _alike(value, stream)
    at = F.instr(value, "@")
    domain = F.substring(value, at + F.lit(1), F.length(value))
    email = F.concat(
        _alike(F.substring(value, F.lit(1), at - F.lit(1)), stream),
        F.lit("@"),
        _let(
            _stream(key, 0, F.lit("domain"), domain),
            lambda s: _alike(F.regexp_extract(domain, r"^(.*)\.", 1), s),
        ),
        F.lit("."),
        F.regexp_extract(domain, r"([^.]*)$", 1),
    )
    octets = F.transform(
        F.sequence(F.lit(0), F.lit(3)), lambda i: (_number(stream, i) % 254 + 1).cast("string")
    )
    body = F.concat(
        F.substring(value, 1, 1), F.substring(alike, F.lit(2), F.length(value) - F.lit(2))
    )
    country = F.substring(value, 1, 2)
    account = F.substring(alike, F.lit(5), F.length(value))
    # of a number with its country, as in +1 (...), the first digit stays
    phone = F.concat(F.substring(value, 1, 1), F.substring(alike, F.lit(2), F.length(value)))
    akia = F.concat(F.substring(value, 1, 4), F.substring(alike, F.lit(5), F.length(value)))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", F.array_join(octets, "."))
        .when(kind == "card", F.concat(body, _luhn(body)))
        .when(kind == "iban", F.concat(country, _mod97(country, account), account))
        .when(kind == "phone", phone)
        .when(kind == "key", akia)
        .when(kind.isin("surname", "given_m", "given_f", "given_n"), _name(kind, value, stream, attempt))
        .otherwise(alike)
    )


def _luhn(body: Column) -> Column:
    """The check digit that makes body + digit pass the Luhn test."""
    n = F.length(body)
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda s, i: s
        + F.when(
            (n - i) % 2 == 0,
            (F.substring(body, i, F.lit(1)).cast("int") * 2 % 10)
            + F.floor(F.substring(body, i, F.lit(1)).cast("int") / 5).cast("int"),
        ).otherwise(F.substring(body, i, F.lit(1)).cast("int")),
    )
    return ((10 - total % 10) % 10).cast("string")


def _mod97(country: Column, account: Column) -> Column:
    """The two check digits of an IBAN."""
    left = F.aggregate(
        F.filter(F.split(F.concat(account, country, F.lit("00")), ""), lambda c: c != ""),
        F.lit(0),
        lambda s, c: F.when(c.rlike("[0-9]"), (s * 10 + F.ascii(c) - 48) % 97).otherwise(
            (s * 100 + F.ascii(c) - 55) % 97
        ),
    )
    return F.lpad((98 - left).cast("string"), 2, "0")


def _name(kind: Column, value: Column, stream: Column, attempt: int) -> Column:
    """Syllables of the script of the name, with an ending for the gender of given names. Later
    attempts get more syllables, so names never run out of forms."""
    count = F.greatest(F.lit(2), F.least(F.lit(5), F.floor(F.length(value) / 2).cast("int")))
    count = count + attempt // 2
    gender = F.when(kind == "given_f", "f").when(kind == "given_m", "m").otherwise("n")

    def spoken(script: str) -> Column:
        syllables = F.array(*[F.lit(s) for s in SYLLABLES[script].split()])
        word = F.array_join(
            F.transform(
                F.sequence(F.lit(0), count - 1),
                lambda i: F.get(syllables, _number(stream, i) % F.size(syllables)),
            ),
            "",
        )
        ending = F.lit("")
        for g, e in ENDINGS[script].items():
            ending = F.when((gender == g) & (kind != "surname"), e).otherwise(ending)
        return F.concat(word, ending)

    return (
        F.when(value.rlike(r"\p{IsCyrillic}"), spoken("cyrillic"))
        .when(value.rlike(r"\p{IsGreek}"), spoken("greek"))
        .otherwise(spoken("latin"))
    )
