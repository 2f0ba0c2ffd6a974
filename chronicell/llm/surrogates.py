r"""PII: detected entities are replaced by keyed surrogates (DataFrame functions only).

Detected are e-mail addresses, IPv4 addresses, telephone numbers (with a country code, or of ten digits in national
form), social security numbers, payment cards (13 to 19 digits with a right check digit), access keys, values after
password or token, and names after a title, of which later mentions in the same document are found without it. A
surrogate has its entity's type and format: digits stay digits and separators stay where they are, a card keeps its first
digit and a right check digit, a telephone number its country code, an address becomes one of a reserved range, a name
keeps its title, its case, its apostrophe or hyphen, its script and its gender.
"""

from __future__ import annotations

import hashlib
import itertools
import secrets
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicell.llm.base import free, materialize, table, text_or_empty

#: The session's setting that holds the secret key.
KEY_SETTING = "spark.chronicell.pii.key"
_DRAWN = secrets.token_hex(32)  # the key of sessions that set none: surrogates agree within this process only
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_TITLES = {
    "m": ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος", "السيد", "מר", "श्री"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία", "السيدة", "גברת", "श्रीमती"),
    "n": ("Dr", "Prof", "Доктор", "الدكتور"),
}
#: Words that begin with a capital letter, or are of a script without capitals.
_NAME = r"[\p{Lu}\p{Lt}\p{Lo}][\p{L}\p{M}'’-]+"
#: Digits in groups, each one space or hyphen apart: where they hold a card, it is found by its check digit and marked
#: with two noncharacters before all patterns are looked for.
_RUN = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}+(?![0-9])"
_OPEN, _CLOSE = "\ufdd0", "\ufdd1"
#: Kind and pattern, in order of precedence at one place.
PATTERNS = (
    ("email", r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"),
    ("key", r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"),
    ("secret", r"(?i:password|passwd|secret|token|api_key)[ \t]{0,3}[=:][ \t]{0,3}[\"']?(?=[_/+-]*[A-Za-z0-9])[A-Za-z0-9_/+-]{8,}"),
    ("ip", rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"),
    ("phone", r"(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])|(?<![0-9+(.-])(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9]|[.-][0-9])"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("card", rf"{_OPEN}[0-9](?:[ -]?[0-9]){{12,}}+{_CLOSE}"),
    ("name", rf"(?<![\p{{L}}])(?:{'|'.join(t for g in _TITLES.values() for t in g)})\.?[ ]{_NAME}(?:[ ]{_NAME})?"),
)
ANY = "|".join(p for _, p in PATTERNS)
_BEFORE_CARDS = "|".join(_RUN if k == "card" else p for k, p in PATTERNS)
# Made-up names: sixteen syllables of a script, and the endings of a man's, a woman's, any given name and a surname.
_SYLLABLES = {
    "latin": ("ba", "be", "da", "de", "fi", "ga", "ka", "la", "li", "ma", "mo", "na", "ra", "ro", "sa", "ta"),
    "cyrillic": ("ба", "бе", "да", "де", "фи", "га", "ка", "ла", "ли", "ма", "мо", "на", "ра", "ро", "са", "та"),
    "greek": ("βα", "βε", "δα", "δε", "φι", "γα", "κα", "λα", "λι", "μα", "μο", "να", "ρα", "ρο", "σα", "τα"),
    "arabic": ("با", "بي", "دا", "دي", "في", "كا", "لا", "لي", "ما", "مو", "نا", "را", "رو", "سا", "تا", "كي"),
    "hebrew": ("בא", "בי", "דא", "די", "פי", "גא", "קא", "לא", "לי", "מא", "מו", "נא", "רא", "רו", "סא", "תא"),
    "devanagari": ("बा", "बे", "दा", "दे", "फी", "गा", "का", "ला", "ली", "मा", "मो", "ना", "रा", "रो", "सा", "ता"),
    "hangul": ("가", "나", "다", "라", "마", "바", "사", "아", "자", "차", "카", "타", "파", "하", "고", "노"),
    "kana": ("ア", "イ", "カ", "キ", "サ", "シ", "タ", "ナ", "ニ", "ハ", "マ", "ミ", "ラ", "リ", "ロ", "ワ"),
    "han": ("安", "白", "成", "东", "方", "高", "国", "海", "江", "林", "明", "宁", "平", "青", "文", "云"),
}
_ENDINGS = {
    "latin": ("ran", "rina", "rel", "ston"), "cyrillic": ("ран", "рина", "рел", "стон"), "greek": ("ραν", "ρινα", "ρελ", "στον"),
    "arabic": ("ن", "ة", "ل", "ي"), "hebrew": ("ן", "ית", "ל", "י"), "devanagari": ("न", "नी", "ल", "कर"),
    "hangul": ("준", "희", "진", ""), "kana": ("オ", "コ", "ミ", "ダ"), "han": ("伟", "芳", "华", ""),
}
#: Scripts by a letter that they have, in the order of testing; other scripts get Latin surrogates.
_SCRIPTS = {"cyrillic": "IsCyrillic", "greek": "IsGreek", "arabic": "IsArabic", "hebrew": "IsHebrew", "devanagari": "IsDevanagari", "hangul": "IsHangul", "kana": "IsHiragana}\\p{IsKatakana", "han": "IsHan"}
#: A value that has no free surrogate after so many attempts gets longer ones, by one more character or syllable each time.
LONGER_AFTER = 8


def may_hold(text: Column) -> Column:
    """False for texts that no pattern can match, by plain searches: without digit or @, without a title, without AKIA and
    the words before secrets. Most texts are such, and the patterns cost far more than these."""
    titles = sorted(t for g in _TITLES.values() for t in g)
    shortest = [t for t in titles if not any(t != u and t.startswith(u) for u in titles)]  # Mrs is found as Mr
    low = F.array(F.lower(text))  # one element: made once for all words
    words = F.exists(low, lambda x: x.contains("passw") | x.contains("secret") | x.contains("token") | x.contains("api_key"))
    return text.rlike("[0-9@]") | reduce(lambda a, b: a | b, (text.contains(t) for t in shortest)) | text.contains("AKIA") | words


def session_key(spark: SparkSession) -> str:
    """The secret key of the session's settings; where there is none, one drawn at random for this process."""
    return spark.conf.get(KEY_SETTING, "") or spark.sparkContext.getConf().get(KEY_SETTING, "") or _DRAWN


def hmac_sha512(key: str, message: Column) -> Column:
    """HMAC-SHA512 in hex digits, by the definition (RFC 2104)."""
    own = key.encode()
    own = (hashlib.sha512(own).digest() if len(own) > 128 else own).ljust(128, b"\0")
    inner, outer = (F.lit(bytes(b ^ x for b in own)) for x in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message.cast("binary")), 512))), 512)


def _hash(key: str, *parts: Column) -> Column:
    """512 hex digits that key, kind, value and attempt decide."""
    text = F.concat_ws("\x1f", *parts)
    return F.concat(*[hmac_sha512(key, F.concat(F.lit(str(k)), text)) for k in range(4)])


def _digits(col: Column) -> Column:
    return F.regexp_replace(col, "[^0-9]", "")


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Check sum from the right; every second digit counts double, the last one too if ``doubled`` is 0."""
    each = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == doubled, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _kind(entity: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS):
        out = F.when(entity.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def _mark_run(run: Column) -> Column:
    """Marks around what 13 to 19 digits with a right check digit cover, from the start of a group to the end of one;
    such parts that overlap are marked as one, such that no card stays."""
    card = lambda d: F.length(d).between(13, 19) & (_luhn_sum(d, 1) % 10 == 0)
    spans = lambda t, i: F.filter(F.sequence(F.least(F.lit(19), F.size(t) - i), F.lit(1), F.lit(-1)), lambda n: card(_digits(F.array_join(F.slice(t, i + 1, n), ""))))
    # (groups with what is before them, groups of the longest card from each on): one element, so that each is made once
    tokens = F.array(F.regexp_extract_all(run, F.lit("[ -]?[0-9]+"), F.lit(0)))
    both = F.transform(tokens, lambda t: F.struct(t.alias("t"), F.transform(t, lambda _, i: F.coalesce(F.get(spans(t, i), F.lit(0)), F.lit(0))).alias("n")))

    def one(x: Column, token: Column, i: Column) -> Column:
        reach = lambda first, last, to: F.exists(F.filter(F.sequence(first, i), lambda j: j <= last), lambda j: j + F.get(x["n"], j) > to)
        first = F.greatest(i - 18, F.lit(0))
        opens = (F.get(x["n"], i) > 0) & ~reach(first, i - 1, i)
        closes = reach(first, i, i) & ~reach(first, i, i + 1)
        return F.concat(F.when(opens, F.regexp_replace(token, "^([ -]?)", f"$1{_OPEN}")).otherwise(token), F.when(closes, F.lit(_CLOSE)).otherwise(""))

    return F.array_join(F.flatten(F.transform(both, lambda x: F.transform(x["t"], lambda token, i: one(x, token, i)))), "")


def mark_cards(text: Column) -> Column:
    """The text with marks around payment cards that are not inside of another entity."""
    hits = F.regexp_extract_all(text, F.lit(f"({_BEFORE_CARDS})"), F.lit(1))
    new = F.transform(hits, lambda e: F.when(e.rlike(f"^{_RUN}$"), _mark_run(e)).otherwise(e))
    pieces = F.split(text, f"(?:{_BEFORE_CARDS})", -1)
    return F.when(text.rlike(_RUN), F.array_join(F.zip_with(pieces, F.concat(new, F.array(F.lit(""))), lambda g, n: F.concat(g, n)), "")).otherwise(text)


def _in_format(entity: Column, digits: Column) -> Column:
    """The entity with its digits replaced, one after another; more digits than it has follow it."""
    n = F.length(_digits(entity))
    new = F.split(F.substring(digits, F.lit(1), n), "")
    text = F.array_join(F.zip_with(F.split(entity, "[0-9]", -1), F.concat(new, F.array(F.lit(""))), lambda g, d: F.concat(g, d)), "")
    return F.concat(text, F.substring(digits, n + 1, F.length(digits)))


def _same_classes(value: Column, stream: Column, hex_only: Column) -> Column:
    """Digits for digits, small and capital letters for such, hex digits for those of a hex number; the rest stays."""
    pairs = F.transform(F.split(value, ""), lambda c, i: F.struct(c.alias("c"), F.conv(F.substring(stream, i % 256 * 2 + 1, F.lit(2)), 16, 10).cast("int").alias("v")))
    pick = lambda letters, v: F.substring(F.lit(letters), v % len(letters) + 1, F.lit(1))
    low, up = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    one = lambda p: (
        F.when(p.c.rlike("[0-9]"), pick("0123456789", p.v))
        .when(p.c.rlike("[a-f]") & p.c.isNotNull() & hex_only, pick("abcdef", p.v))
        .when(p.c.rlike("[a-z]"), pick(low, p.v))
        .when(p.c.rlike("[A-Z]"), pick(up, p.v))
        .otherwise(p.c)
    )
    return F.array_join(F.transform(pairs, one), "")


def _script(word: Column) -> Column:
    out = F.lit("latin")
    for name, letters in reversed(_SCRIPTS.items()):
        out = F.when(word.rlike(rf"[\p{{{letters}}}]"), name).otherwise(out)
    return out


def _syllable(name: str, digit: Column) -> Column:
    return F.get(F.array(*map(F.lit, _SYLLABLES[name])), F.conv(digit, 16, 10).cast("int"))


def _word(kind: Column, word: Column, stream: Column) -> Column:
    """A made-up name of four syllables (of scripts that write one with a character, two) with the ending of its gender
    (of a surname: its own)."""
    out = F.lit(None).cast("string")
    script = _script(word)
    for name, endings in _ENDINGS.items():
        made = F.concat(*[_syllable(name, F.substring(stream, k + 1, 1)) for k in range(2 if name in ("han", "hangul") else 4)])
        ending = F.lit(None).cast("string")
        for gender, text in zip("mfns", endings):
            ending = F.when(kind == F.lit(f"name-{gender}"), text).otherwise(ending)
        out = F.when(script == name, F.initcap(F.concat(made, ending))).otherwise(out)
    return out


def _styled(new: Column, old: Column) -> Column:
    """A made-up name written as the old one: all capitals, or with an apostrophe after the first letter or a hyphen."""
    first = F.regexp_extract(old, r"^\p{L}{1,2}(['’])(?=\p{L})", 1)
    lower = F.concat(F.substring(new, 1, 1), first, F.initcap(F.substring(new, F.lit(2), F.length(new))))
    half = (F.length(new) / 2).cast("int")
    hyphened = F.concat(F.substring(new, F.lit(1), half), F.lit("-"), F.initcap(F.substring(new, half + 1, F.length(new))))
    out = F.when(first != "", lower).when(old.rlike(r"\p{L}-\p{L}"), hyphened).otherwise(new)
    return F.when((old == F.upper(old)) & (old != F.lower(old)) & (F.length(old) > 1), F.upper(out)).otherwise(out)


def _surrogate(kind: Column, canon: Column, stream: Column) -> Column:
    """The canonical surrogate of a canonical value (digits for numbers, lower case for addresses)."""
    numbers = F.translate(stream, "abcdef", "123456")
    octet = lambda k: F.conv(F.substring(stream, k, 2), 16, 10)
    body = F.concat(F.substring(canon, 1, 1), F.substring(F.repeat(numbers, F.floor(F.length(canon) / 512).cast("int") + 1), F.lit(1), F.length(canon) - 2))
    hex_only = canon.rlike("^[0-9a-f]+$")
    return (
        F.when(kind == "ip", F.concat_ws(".", (F.lit(240) + octet(1).cast("int") % 15).cast("string"), octet(3), octet(5), octet(7)))
        .when(kind == "card", F.concat(body, ((10 - _luhn_sum(body, 0) % 10) % 10).cast("string")))
        .when(kind == "phone", F.concat(F.substring_index(canon, " ", 1), F.lit(" "), F.substring(numbers, F.lit(1), F.length(F.substring_index(canon, " ", -1)))))
        .when(kind == "ssn", F.concat(F.lit("9"), F.substring(numbers, 1, 8)))
        .when(kind == "email", F.concat(_same_classes(F.substring_index(canon, "@", 1), stream, F.lit(False)), F.lit("@")))
        .when(kind == "domain", F.concat(F.lit("m"), F.substring(stream, 1, 12), F.lit(".example."), F.get(F.array(*map(F.lit, ("com", "net", "org"))), F.conv(F.substring(stream, 20, 1), 16, 10).cast("int") % 3)))
        .when(kind == "key", F.concat(F.lit("AKIA"), _same_classes(F.substring(canon, 5, 16), stream, F.lit(False))))
        .when(kind == "secret", _same_classes(canon, stream, hex_only))
        .otherwise(_word(kind, canon, stream))
    )


def _longer(kind: Column, canon: Column, surrogate: Column, stream: Column, attempt: Column) -> Column:
    """The surrogate with what the attempt adds to it; cards and domains have at least 10^11 surrogates and stay."""
    n = F.greatest(attempt - LONGER_AFTER + 1, F.lit(0))
    more = F.substring(F.substring(stream, 257, 256), F.lit(1), n)
    digits = F.translate(more, "abcdef", "123456")
    out = (
        F.when(kind.isin("phone", "ssn"), F.concat(surrogate, digits))
        .when(kind == "ip", F.concat(surrogate, F.lit("."), digits))
        .when(kind == "email", F.concat(F.substring_index(surrogate, "@", 1), more, F.lit("@")))
        .when(kind == "key", F.concat(surrogate, F.upper(more)))
        .when(kind == "secret", F.concat(surrogate, more))
    )
    script = _script(canon)
    for name in _SYLLABLES:
        added = F.array_join(F.transform(F.split(more, ""), lambda c: _syllable(name, c)), "")
        out = F.when(kind.startswith("name-") & (script == name), F.initcap(F.concat(added, F.lower(surrogate)))).otherwise(out)
    return F.when(n > 0, F.coalesce(out, surrogate)).otherwise(surrogate)


def _canonical(entities: DataFrame) -> DataFrame:
    """(entity, kind, canon, rest): rest is what else the surrogate is made of (an address's domain, a given name)."""
    e, kind = F.col("entity"), F.col("kind")
    country = F.regexp_extract(e, r"^\+([0-9]{1,3})(?=[ .(-])", 1)
    country = F.when(~e.startswith("+"), "").when(country != "", country).otherwise(F.substring(e, 2, 1))
    number = _digits(e)
    words = F.split(e, " ")
    gender = F.lit("n")
    for g, titles in _TITLES.items():
        gender = F.when(F.regexp_replace(F.get(words, F.lit(0)), r"\.$", "").isin(*titles), g).otherwise(gender)
    canon = (
        F.when(kind == "email", F.lower(e))
        .when(kind == "phone", F.concat(country, F.lit(" "), F.substring(number, F.length(country) + 1, F.lit(32))))
        .when(kind.isin("ssn", "card"), number)
        .when(kind == "name", F.lower(F.element_at(words, -1)))
        .when(kind == "secret", F.regexp_extract(e, "([A-Za-z0-9_/+-]+)$", 1))
        .otherwise(e)
    )
    rest = F.when(kind == "email", F.lower(F.substring_index(e, "@", -1))).when((kind == "name") & (F.size(words) == 3), F.lower(F.get(words, F.lit(1))))
    return entities.select("entity", "kind", canon.alias("canon"), rest.alias("rest"), gender.alias("gender"))


def _with_rest_kind(forms: DataFrame) -> DataFrame:
    """Adds rest_kind: a given name has the gender that its titles tell anywhere, any where they tell none or both."""
    told = forms.filter("kind = 'name' AND rest IS NOT NULL").groupBy(F.col("rest").alias("_rest")).agg(F.bool_or(F.col("gender") == "m").alias("m"), F.bool_or(F.col("gender") == "f").alias("f"))
    told = told.select("_rest", F.when(F.col("m") & ~F.col("f"), "name-m").when(F.col("f") & ~F.col("m"), "name-f").otherwise("name-n").alias("rest_kind"))
    return forms.join(told, forms["rest"].eqNullSafe(told["_rest"]) & (forms["kind"] == "name"), "left").drop("_rest", "gender")


def surrogate_map(entities: DataFrame, key: str | None = None) -> DataFrame:
    """(entity, kind, surrogate, pairs) for different (entity, kind); pairs are the words of a name with the new ones.

    Values are compared in a canonical form (digits of a number, lower case of an address or name), so an entity has one
    surrogate however it is written and wherever it stands, and so have a domain, a given name and a surname of their own.
    Surrogates come from an HMAC of kind and value under ``key`` (None: the session's). Where two values of a kind would get the same surrogate, or
    one that is itself a value found in the corpus, the smallest value keeps it (in the second case none does) and the
    others try again, with longer surrogates after LONGER_AFTER attempts, until all differ. Addresses differ by their
    local part or by their domain, which has a surrogate of its own.
    """
    key = key or session_key(entities.sparkSession)
    forms = materialize(_with_rest_kind(_canonical(entities)), "pii-forms")
    main = forms.select(F.when(F.col("kind") == "name", "name-s").otherwise(F.col("kind")).alias("kind"), "canon")
    more = forms.filter("rest IS NOT NULL").select(F.when(F.col("kind") == "email", "domain").otherwise(F.col("rest_kind")).alias("kind"), F.col("rest").alias("canon"))
    values = materialize(main.unionByName(more).distinct(), "pii-values")
    made = values.select("kind", "canon", F.lit(0).alias("attempt"))
    scope = F.when(F.col("kind") == "email", F.substring_index("canon", "@", -1)).otherwise("")
    for k in itertools.count():
        streamed = made.select("kind", "canon", "attempt", _hash(key, F.col("kind"), F.col("canon"), F.col("attempt").cast("string")).alias("stream"))
        # Written before use: the stream is read character by character and must not be hashed anew for each.
        streamed = materialize(streamed, f"pii-streams-{k}")
        tried = streamed.select("kind", "canon", "attempt", _surrogate(F.col("kind"), F.col("canon"), F.col("stream")).alias("surrogate"), "stream")
        longer = _longer(F.col("kind"), F.col("canon"), F.col("surrogate"), F.col("stream"), F.col("attempt")) if k >= LONGER_AFTER else F.col("surrogate")
        tried = materialize(tried.select("kind", "canon", "attempt", longer.alias("surrogate")), f"pii-tried-{k}")
        winners = tried.groupBy("kind", "surrogate", scope.alias("_scope")).agg(F.min("canon").alias("canon"))
        taken = values.select("kind", F.lower("canon").alias("surrogate"))
        unused = winners.withColumn("_low", F.lower("surrogate")).join(taken.withColumnRenamed("surrogate", "_low"), ["kind", "_low"], "left_anti").drop("_low")
        good = unused.select("kind", "canon", F.lit(True).alias("good"))
        judged = materialize(tried.join(good, ["kind", "canon"], "left"), f"pii-judged-{k}")
        free(streamed, tried, *([last] if k else []))
        if judged.filter("good IS NULL").isEmpty():
            break
        last = judged
        made = judged.select("kind", "canon", (F.col("attempt") + F.when(F.col("good").isNull(), 1).otherwise(0)).alias("attempt"))
    found = judged.select("kind", "canon", "surrogate")
    a = found.withColumnsRenamed({"kind": "_kind", "canon": "_canon", "surrogate": "own"})
    b = found.withColumnsRenamed({"kind": "_kind2", "canon": "_canon2", "surrogate": "other"})
    named = F.when(F.col("kind") == "name", "name-s").otherwise(F.col("kind"))
    second = F.when(F.col("kind") == "email", "domain").otherwise(F.col("rest_kind"))
    joined = forms.join(a, (named == F.col("_kind")) & (F.col("canon") == F.col("_canon"))).join(b, (second == F.col("_kind2")) & (F.col("rest") == F.col("_canon2")), "left")
    e, kind, own, other = F.col("entity"), F.col("kind"), F.col("own"), F.col("other")
    words = F.split(e, " ")
    surname, given = F.element_at(words, -1), F.get(words, F.lit(1))
    full = F.concat_ws(" ", F.get(words, F.lit(0)), F.when(other.isNotNull(), _styled(other, given)), _styled(own, surname))
    out = (
        F.when(kind.isin("phone", "ssn", "card"), _in_format(F.translate(e, _OPEN + _CLOSE, ""), _digits(own)))
        .when(kind == "email", F.concat(own, other))
        .when(kind == "name", full)
        .when(kind == "secret", F.concat(F.regexp_extract(e, "^(.*?)[A-Za-z0-9_/+-]+$", 1), own))
        .otherwise(own)
    )
    pair = lambda old, new: F.struct(old.alias("old"), _styled(new, old).alias("new"))
    pairs = F.when(kind == "name", F.array_compact(F.array(pair(surname, own), F.when(other.isNotNull(), pair(given, other)))))
    made = materialize(joined.select("entity", "kind", out.alias("surrogate"), pairs.alias("pairs")), "pii-surrogates")
    free(forms, values, judged)
    return made


def _later_mentions(text: Column, pairs: Column) -> Column:
    """The text with the words of ``pairs`` replaced wherever they stand alone, as written and in capitals."""
    both = F.flatten(F.transform(pairs, lambda p: F.array(p, F.struct(F.upper(p["old"]).alias("old"), F.upper(p["new"]).alias("new")))))
    whole = lambda old: F.concat(F.lit(r"(?<![\p{L}\p{M}\p{N}])\Q"), old, F.lit(r"\E(?![\p{L}\p{M}\p{N}])"))
    return F.aggregate(F.filter(both, lambda p: F.length(p["old"]) > 1), text, lambda t, p: F.when(F.contains(t, p["old"]), F.regexp_replace(t, whole(p["old"]), p["new"])).otherwise(t))


def replace_entities(docs: DataFrame, key: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, with surrogates in their texts, and n_entities (array kinds: the kinds, in order).

    Texts that no pattern can match are told by plain searches and pass straight through, without a shuffle. The others
    are cut at their entities; the pieces between stay with the text, only the entities are exploded, looked up and
    gathered again by document. The words of a document's names are then replaced wherever else they stand in it.
    Equal rows are looked up once. ``key`` is a secret (None: that of the session, see ``session_key``). Tables of what
    was found in clear text are deleted before this returns; what is left holds surrogates and the words of names.

    Null and empty texts have no entities and stay; null ids are an id; empty tables give no rows; very long texts are
    read whole; columns named n_entities or kinds are replaced, other names do not clash.
    """
    rest = docs.drop("n_entities", "kinds")
    columns = rest.columns
    clean = rest.filter(~may_hold(text_or_empty(text_col))).withColumns({"n_entities": F.lit(0).cast("long"), "kinds": F.array().cast("array<string>")})
    rest = rest.filter(may_hold(text_or_empty(text_col)))
    fp = F.xxhash64(text_or_empty(text_col))
    doc = F.col(id_col).cast("long")
    marked = mark_cards(text_or_empty(text_col))
    hits = F.regexp_extract_all(marked, F.lit(f"({ANY})"), F.lit(1))
    found = rest.select(doc.alias("_doc"), fp.alias("_fp"), F.posexplode_outer(hits).alias("_pos", "entity")).filter("_pos IS NOT NULL")
    found = materialize(found.distinct(), "pii-found")
    kinds = materialize(found.select("entity").distinct().withColumn("kind", _kind(F.col("entity"))).filter("kind IS NOT NULL"), "pii-kinds")
    replaced = surrogate_map(kinds, key)
    looked_up = found.join(replaced, "entity", "left").select("_doc", "_fp", F.struct("_pos", F.coalesce("surrogate", "entity").alias("new"), "kind", "pairs").alias("x"))
    by_doc = materialize(looked_up.groupBy("_doc", "_fp").agg(F.sort_array(F.collect_list("x")).alias("_new")), "pii-by-document")
    free(found, kinds, replaced)
    own = rest.withColumns({"_id": doc, "_key": fp})
    joined = own.join(by_doc.hint("merge"), F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_fp")), "left")
    pieces = F.split(mark_cards(F.col(text_col)), f"(?:{ANY})", -1)
    text = F.array_join(F.zip_with(pieces, F.concat(F.transform("_new", lambda x: x["new"]), F.array(F.lit(""))), lambda g, n: F.concat(g, n)), "")
    pairs = F.array_distinct(F.flatten(F.filter(F.transform("_new", lambda x: x["pairs"]), lambda p: p.isNotNull())))
    text = F.when(F.size(pairs) > 0, _later_mentions(text, pairs)).otherwise(text)
    known = F.filter(F.transform("_new", lambda x: x.kind), lambda k: k.isNotNull())
    replaced = joined.select(
        *[F.when(F.col("_new").isNotNull(), text).otherwise(F.col(c)).alias(c) if c == text_col else F.col(c) for c in columns],
        F.coalesce(F.size(known), F.lit(0)).cast("long").alias("n_entities"), F.coalesce(known, F.array().cast("array<string>")).alias("kinds"),
    )
    return replaced.unionByName(clean)


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "text", "n_entities", "kinds")
