"""Scalar text functions as JVM-side column expressions: names, addresses, phonetics.

Every function takes columns (or names) and returns a column, so it works on any DataFrame.  Words are
arrays of strings.  Only mojibake, NFKC and transliteration need Python; see ``unicode``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
#: Spellings of legal forms and their canonical words.
LEGAL_FORMS = {
    "incorporated": "inc", "inc": "inc", "corporation": "corp", "corp": "corp", "company": "co", "co": "co", "limited": "ltd", "ltd": "ltd", "private": "pvt", "pvt": "pvt",
    "llc": "llc", "llp": "llp", "pllc": "pllc", "lp": "lp", "sarl": "sarl", "sas": "sas", "sasu": "sasu", "eurl": "eurl", "sa": "sa", "selarl": "selarl", "snc": "snc",
    "gmbh": "gmbh", "plc": "plc", "pty": "pty", "pte": "pte", "bhd": "bhd", "sdn": "sdn", "srl": "srl", "opc": "opc",
}
#: Words by whose sound a legal form is recognised.
LEGAL_SOUNDS = ["private", "limited", "pvt", "ltd", "company", "corporation", "corp", "incorporated", "llc", "llp", "pllc", "sarl", "kampani"]
#: Letters that sound alike; vowels, h and y are dropped.
SOUND_FROM, SOUND_TO, SOUND_DROP = "bvwpfcszjxdtkgqmnrl", "bbbbbsssssddkkkmnrl", "aeiouhy"
TOP_DOMAINS = r"co\.in|co\.uk|com|net|org|in|co|biz|info|us|fr|io"
NULL_WORDS = ["null", "none", "nan", "nil", "na"]
WORD_ORDINALS = {"first": "1", "second": "2", "third": "3", "fourth": "4", "fifth": "5", "sixth": "6", "seventh": "7", "eighth": "8", "ninth": "9", "tenth": "10", "eleventh": "11", "twelfth": "12"}
SCRIPTS = {
    "Devanagari": (0x0900, 0x097F), "Bengali": (0x0980, 0x09FF), "Gurmukhi": (0x0A00, 0x0A7F), "Gujarati": (0x0A80, 0x0AFF), "Oriya": (0x0B00, 0x0B7F), "Tamil": (0x0B80, 0x0BFF), "Telugu": (0x0C00, 0x0C7F),
    "Kannada": (0x0C80, 0x0CFF), "Malayalam": (0x0D00, 0x0D7F), "Latin-Extended-Accented": (0x00C0, 0x024F), "Arabic": (0x0600, 0x06FF), "Cyrillic": (0x0400, 0x04FF), "CJK": (0x4E00, 0x9FFF),
}


def sound(word: str) -> str:
    """The consonant skeleton of a literal."""
    table = {**dict.fromkeys(SOUND_DROP, ""), **dict(zip(SOUND_FROM, SOUND_TO, strict=True))}
    return "".join(table.get(c, c if c.isdigit() else "") for c in word)


# ---------------------------------------------------------------- helpers
def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text: Column | str) -> Column:
    """Words of a text between white space."""
    return F.filter(F.split(F.coalesce(_col(text), F.lit("")), r"\s+"), lambda x: x != "")


def joined(tokens: Column | str, by: str = " ") -> Column:
    return F.array_join(_col(tokens), by)


def looked_up(x: Column, table: dict[str, str]) -> Column:
    pairs = F.create_map(*[F.lit(v) for kv in table.items() for v in kv])
    return F.coalesce(F.try_element_at(pairs, x), x)


def collapsed(tokens: Column) -> Column:
    """Of equal neighbours the first."""
    return F.filter(tokens, lambda x, i: (i == 0) | (x != F.get(tokens, i - 1)))


def is_digits(x: Column) -> Column:
    return x.rlike("^[0-9]+$")


def not_empty(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null unless b is positive."""
    return F.when(b > 0, a / b)


# ---------------------------------------------------------------- names
def non_ascii(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit("")).rlike(r"[^\x00-\x7F]")


def non_latin(c: Column | str) -> Column:
    """Whether there is a letter from U+0370 on."""
    return F.coalesce(_col(c), F.lit("")).rlike(r"[\p{L}&&[^\u0000-ͯ]]")


def apostrophes(c: Column | str) -> Column:
    """``l'atelier`` becomes two words, any other quote mark goes."""
    x = F.translate(_col(c), "`´‘’ʼ′", "''''''")
    return F.translate(F.regexp_replace(x, r"(?i)\b(qu|l|d)'(?=[a-z])", "$1 "), "'", "")


def skeleton(c: Column | str) -> Column:
    """Consonant skeleton of a word: vowels and h go, letters that sound alike become one, digits stay."""
    x = F.regexp_replace(_col(c), f"[{SOUND_DROP}]", "")
    return F.regexp_replace(F.translate(x, SOUND_FROM, SOUND_TO), "[^bsdkmnrl0-9]", "")


def case_lookalikes(c: Column | str) -> Column:
    """``OUTSHlNE`` and ``heIIo``: l among capitals and I among small letters, word by word."""

    def fix(t: Column) -> Column:
        no_l, no_i = F.replace(t, F.lit("l"), F.lit("")), F.replace(t, F.lit("I"), F.lit(""))
        capitals = t.contains("l") & no_l.rlike("[A-Z].*[A-Z]") & ~no_l.rlike("[a-z]")
        small = t.contains("I") & t.rlike("^[a-z]") & no_i.rlike("[a-z].*[a-z]") & ~no_i.rlike("[A-Z]")
        return F.when(F.length(t) < 3, t).when(capitals, F.replace(t, F.lit("l"), F.lit("I"))).when(small, F.replace(t, F.lit("I"), F.lit("l"))).otherwise(t)

    parts = F.regexp_extract_all(_col(c), F.lit("([A-Za-z0-9]+|[^A-Za-z0-9]+)"), F.lit(1))
    return joined(F.transform(parts, fix), "")


def web_names(c: Column | str) -> Column:
    """``www.a-b.co.in``, ``ab.com``: the host without hyphens, followed by com."""
    marked = F.regexp_replace(_col(c), rf"(?i)(?:https?://)?(?:www\.)?([a-z0-9][a-z0-9\-]*)\.(?:{TOP_DOMAINS})\b", "\u0001$1\u0002")
    return F.replace(F.replace(F.regexp_replace(marked, "(?<=\u0001[a-zA-Z0-9\\-]{0,200})-", ""), F.lit("\u0001"), F.lit("")), F.lit("\u0002"), F.lit("com"))


def digit_lookalikes(t: Column) -> Column:
    """Single digits inside a word of three letters and more become the letters they look like."""
    letters = F.length(F.regexp_replace(t, "[0-9]", ""))
    odd = t.rlike("[0-9]") & ~is_digits(t) & (letters >= 3) & ~t.rlike("[0-9].*[0-9].*[0-9]") & ~t.rlike("[0-9][0-9]") & ~t.rlike("^[0-9]+(st|nd|rd|th)$")
    return F.when(odd, F.translate(t, "013456789", "oleasgtbg")).otherwise(t)


def alias_marks(c: Column | str) -> Column:
    """Written-out alias marks become the word dba."""
    pattern = r"(?i)\b(?:d\s*/\s*b\s*/\s*a|t\s*/\s*a|d\.\s*b\.\s*a\.?|a\.\s*k\.\s*a\.?|f\.\s*k\.\s*a\.?|doing business as)(?=\s|$|[^a-z])"
    return F.regexp_replace(_col(c), pattern, " dba ")


def legal_word(t: Column) -> Column:
    return looked_up(t, LEGAL_FORMS)


def name_tokens(c: Column | str) -> Column:
    x = F.replace(F.regexp_replace(_col(c), "[&+]", " and "), F.lit("."), F.lit(""))
    tokens = words(F.regexp_replace(F.lower(x), "[^a-z0-9 ]", " "))
    return F.transform(tokens, lambda t: legal_word(F.when(digit_lookalikes(t) == "et", F.lit("and")).otherwise(digit_lookalikes(t))))


def typo_of_legal(t: Column, own: Column | None = None) -> Column:
    """A misspelt legal form: the sound (``own``) of one, and within a quarter of its letters."""
    own, out = skeleton(t) if own is None else own, F.lit(False)
    for w in LEGAL_SOUNDS:
        if len(w) >= 5:
            out = out | ((own == sound(w)) & (F.levenshtein(t, F.lit(w)) <= max(1, len(w) // 4)))
    return out


def sounded(tokens: Column) -> Column:
    """Tokens with their skeletons."""
    return F.transform(tokens, lambda t: F.struct(t.alias("t"), skeleton(t).alias("s")))


def is_legal(x: Column, script: Column) -> Column:
    """Whether a token with its skeleton is a legal form."""
    sounds = sorted({s for s in map(sound, LEGAL_SOUNDS) if len(s) >= 3})
    return x.t.isin(*sorted(set(LEGAL_FORMS.values()))) | (x.s.isin(*sounds) & (script | typo_of_legal(x.t, x.s)))


def without_legal(tokens: Column, script: Column) -> Column:
    """Sounded tokens that are no legal forms."""
    return F.filter(tokens, lambda x: ~is_legal(x, script))


def core(tokens: Column, kept: Column, script: Column) -> Column:
    """Words of a name without legal forms; never empty where there are tokens.  ``kept`` is ``without_legal(tokens)``."""
    last, before = F.try_element_at(kept, F.lit(-1)), F.try_element_at(kept, F.lit(-2))
    tail = script & (F.size(kept) > 2) & (before.s == "br") & last.s.isin("l", "lmd") & (F.length(last.t) <= 4)
    plain = F.filter(tokens, lambda x: ~x.t.isin(*sorted(set(LEGAL_FORMS.values()))))
    out = F.when(tail, F.slice(kept, F.lit(1), F.size(kept) - 2)).when(F.size(kept) > 0, kept).when(F.size(plain) > 0, plain).otherwise(tokens)
    return F.transform(out, lambda x: x.t)


# ---------------------------------------------------------------- addresses
def masked_numbers(c: Column | str) -> Column:
    """``##97`` as xx97, for every mask of two and more signs."""
    found = F.regexp_extract_all(_col(c), F.lit(r"(#{2,}\s*[0-9]+)"), F.lit(1))
    return F.transform(found, lambda m: F.concat(F.repeat(F.lit("x"), F.length(F.regexp_replace(m, "[^#]", ""))), F.regexp_replace(m, "[^0-9]", "")))


def postal_code(c: Column | str) -> Column:
    """The last number of 5 or 6 digits after a letter, else ``ddd ddd`` at the end after a letter; empty if none."""
    x = F.regexp_extract(_col(c), r"^.*\p{L}.*(?<![0-9])([0-9]{5,6})(?![0-9])", 1)
    y = F.regexp_extract(_col(c), r"\p{L}.*(?<![0-9])([0-9]{3}\s[0-9]{3})\s*$", 1)
    return F.when(x != "", x).otherwise(F.regexp_replace(y, r"\s", ""))


def address_text(c: Column | str) -> Column:
    """The rewrites of an address that has been transliterated: house-no, p.o., dotted, ordinals, glue, leading zeros."""
    x = F.lower(_col(c))
    x = F.regexp_replace(x, r"\bh\s*\.?\s*no\b\.?", " hno ")
    x = F.regexp_replace(x, r"\bp\s*\.\s*o\b\.?", " po ")
    x = F.regexp_replace(x, r"\b([a-z])\.(?=[a-z]\b)", "$1")
    x = F.regexp_replace(F.replace(x, F.lit("&"), F.lit(" and ")), "[^a-z0-9 ]", " ")
    x = F.regexp_replace(x, r"\b([0-9]+)(?:st|nd|rd|th)\b", "$1")
    x = F.regexp_replace(x, "(?<=[0-9])(?=[a-z])|(?<=[a-z])(?=[0-9])", " ")
    return F.regexp_replace(x, r"\b0+(?=[0-9])", "")


def address_word(t: Column) -> Column:
    """Word of an address for comparison: 0064 is 64, 316th and no21 lose letters, first to twelfth are numbers, null words are empty."""
    number = F.regexp_extract(t, "^(?:no)?0*([0-9]+)(?:st|nd|rd|th)?$", 1)
    return F.when(t.isin(*NULL_WORDS), "").when(t.isin(*WORD_ORDINALS), looked_up(t, WORD_ORDINALS)).when(number != "", number).otherwise(t)


def address_words(c: Column | str) -> Column:
    return F.filter(F.transform(words(c), address_word), lambda x: x != "")


def blocking_address_word(t: Column) -> Column:
    """Word of an address as a key: leading zeros, ordinals, no21."""
    x = F.when(is_digits(t), F.regexp_replace(t, "^0+(?=[0-9])", "")).otherwise(t)
    return F.regexp_replace(F.regexp_replace(x, "^([0-9]+)(?:st|nd|rd|th)$", "$1"), "^no([0-9]+)$", "$1")


def slot(c: Column | str) -> Column:
    """Comparable value of an address field; the label words go only where a space follows them."""
    x = F.lower(F.coalesce(_col(c), F.lit("")))
    for label in ("no ", "number ", "num ", "# "):
        x = F.when(x.startswith(label), F.substr(x, F.lit(len(label) + 1))).otherwise(x)
    return F.regexp_replace(F.regexp_replace(x, r"[\s\-/.,#]+", ""), "(?<![0-9])0+(?=[0-9])", "")


def first_number(c: Column | str) -> Column:
    """The first word that is all digits; empty if none."""
    return F.coalesce(F.try_element_at(F.filter(words(c), is_digits), F.lit(1)), F.lit(""))


def numbers(tokens: Column, most: int = 8) -> Column:
    return F.filter(tokens, lambda t: is_digits(t) & (F.length(t) <= most))


def pin_digits(c: Column | str) -> Column:
    """Digits of a postal code of 3 to 8, else null."""
    x = F.regexp_replace(F.coalesce(_col(c), F.lit("")), "[^0-9]", "")
    return F.when(F.length(x).between(3, 8), x)


# ---------------------------------------------------------------- phonetics of keys
def key_word(t: Column) -> Column:
    """Word of a name as a key: look-alike digits, web endings, m before a consonant."""
    x = F.when(t.rlike("[a-z]"), F.translate(t, "013456789", "oleasgtbg")).otherwise(t)
    long = F.length(x) >= 6
    y = F.when(x.isin("com", "net", "org", "www"), "").otherwise(x)
    y = F.when(long, F.regexp_replace(F.regexp_replace(y, "(?:com|net|org)$", ""), "^www", "")).otherwise(y)
    return F.regexp_replace(y, "m(?=[cdgjklnqrstwxz])", "n")


def key_words(tokens: Column) -> Column:
    """Key words of a name, without pure numbers of five digits and more."""
    return F.filter(F.transform(tokens, key_word), lambda x: (x != "") & ~x.rlike("^[0-9]{5,}$"))


def skeleton_word(t: Column, coarse: bool = False) -> Column:
    """Skeleton with soft c and g, -tio-, x, -tur-, silent gh and nasals before consonants; ``coarse`` drops every nasal."""
    x = F.replace(F.regexp_replace(t, "t(?=i[oa])", "s"), F.lit("x"), F.lit("ks"))
    x = F.regexp_replace(x, "(?<=[aeiouy])g(?=h)", "")
    x = F.regexp_replace(x, "(?<=[a-z])t(?=ur)", "K")
    x = F.regexp_replace(F.regexp_replace(x, "[cg](?=[eiy])", "S"), "[cg]", "K")
    x = F.regexp_replace(x, "[nm]" if coarse else "[nm](?=[a-zKS&&[^aeiou]])", "")
    x = F.translate(F.regexp_replace(x, "[aeiouhy]", ""), "mvwpfzjtqSK", "nbbbbssdksk")
    return F.regexp_replace(x, r"(.)\1+", "$1")


def skeleton_words(tokens: Column, coarse: bool = False) -> Column:
    return F.filter(F.transform(tokens, lambda t: skeleton_word(t, coarse)), lambda x: x != "")


def truncated(tokens: Column, k: int) -> Column:
    return F.transform(tokens, lambda t: F.substr(t, F.lit(1), F.lit(k)))


def ngrams(c: Column | str, n: int) -> Column:
    """Distinct character n-grams, spaces included; none of shorter texts."""
    x = _col(c)
    return F.when(F.length(x) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(x) - (n - 1)), lambda i: F.substr(x, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def word_trigrams(tokens: Column) -> Column:
    """3-grams of every word between spaces, with repeats."""
    pad = lambda t: F.concat(F.lit(" "), t, F.lit(" "))
    return F.flatten(F.transform(tokens, lambda t: F.transform(F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))), lambda i: F.substr(pad(t), i, F.lit(3)))))


def signature(flat: Column) -> Column:
    """Distinct bigrams and trigrams of a name without spaces."""
    return F.array_union(ngrams(flat, 2), ngrams(flat, 3))


# ---------------------------------------------------------------- phonetics of features
def feature_word(t: Column) -> Column:
    """Single look-alike digits in a word of two letters and more."""
    x = F.replace(t, F.lit("'"), F.lit(""))
    mixed = x.rlike("[0-9]") & (F.length(F.regexp_replace(x, "[^a-z]", "")) >= 2)
    y = F.regexp_replace(x, "(?<![0-9])([013458])(?![0-9])", "\u0001$1")
    for digit, letter in zip("013458", "oleasb", strict=True):
        y = F.replace(y, F.lit(f"\u0001{digit}"), F.lit(letter))
    return F.when(mixed, y).otherwise(x)


def stripped_web(tokens: Column) -> Column:
    """Words of a web name without www and the domain ending."""
    x = F.when(F.get(tokens, F.lit(0)) == "www", F.slice(tokens, 2, 1000)).otherwise(tokens)
    ends = ["info", "com", "net", "org", "biz", "io", "co", "in", "fr", "us", "uk"]
    last = F.try_element_at(x, F.lit(-1))
    head = F.slice(x, F.lit(1), F.greatest(F.size(x) - 1, F.lit(0)))
    out = F.when(last.isin(*ends) & (F.size(x) > 1), head)
    for e in ends:
        out = out.when(last.endswith(e) & (F.length(last) - len(e) >= 3), F.concat(head, F.array(F.substr(last, F.lit(1), F.length(last) - len(e)))))
    return out.otherwise(x)


def feature_name(c: Column | str, web: Column) -> Column:
    tokens = F.filter(F.transform(words(c), feature_word), lambda t: t != "")
    return joined(F.when(web, stripped_web(tokens)).otherwise(tokens))


def phonetic(t: Column) -> Column:
    """Skeleton that keeps the first letter: laxmi, lakshmi and laksmi are lksm, shree and sri are sr."""
    x = F.replace(F.regexp_replace(t, "[^a-z]", ""), F.lit("ph"), F.lit("f"))
    x = F.regexp_replace(x, "(?<=[b-df-hj-np-tv-z])h", "")
    x = F.regexp_replace(x, "c(?=[eiy])", "s")
    x = F.translate(F.replace(x, F.lit("x"), F.lit("ks")), "cqzwy", "kksvi")
    x = F.regexp_replace(x, "m(?=[^aeioupbmv])", "n")
    x = F.concat(F.regexp_replace(F.substr(x, F.lit(1), F.lit(1)), "[aeiou]", "a"), F.regexp_replace(F.substr(x, F.lit(2)), "[aeiou]", ""))
    return F.regexp_replace(x, r"(.)\1+", "$1")


def phonetic_words(c: Column | str) -> Column:
    return F.filter(F.transform(words(c), phonetic), lambda x: x != "")


def canonical_legal(t: Column) -> Column:
    """Canonical legal word by spelling, else by sound, else the word."""
    by_sound: dict[str, str] = {}
    for w, c in LEGAL_FORMS.items():
        if len(sound(w)) >= 3:
            by_sound.setdefault(sound(w), c)
    spelt = F.create_map(*[F.lit(v) for kv in LEGAL_FORMS.items() for v in kv])
    heard = F.create_map(*[F.lit(v) for kv in by_sound.items() for v in kv])
    return F.coalesce(F.try_element_at(spelt, t), F.try_element_at(heard, skeleton(t)), t)


def legal_words(translit: Column | str, name_core: Column | str) -> Column:
    """Canonical legal words that the full name has beyond its core."""
    extra = F.filter(F.array_except(words(F.lower(_col(translit))), words(F.lower(_col(name_core)))), lambda t: t.rlike("^[a-z]+$"))
    return F.array_sort(F.array_distinct(F.transform(extra, canonical_legal)))


def stripped_initials(translit: Column | str, name_core: Column | str) -> Column:
    """First letters of the words (two letters and more) that cleaning took from a name, at most four."""
    own = words(name_core)
    gone = F.filter(words(translit), lambda t: ~F.array_contains(own, t) & (F.length(t) >= 2))
    return joined(F.transform(F.slice(gone, 1, 4), lambda t: F.substr(t, F.lit(1), F.lit(1))), "")


def legal_agreement(a: Column, b: Column) -> Column:
    """1 same, -1 different, -0.5 on one side only, 0 on neither; empty is none."""
    return F.when((a != "") & (b != ""), F.when(a == b, 1.0).otherwise(-1.0)).when((a != "") | (b != ""), -0.5).otherwise(0.0)


def abbreviates(short: Column, initials: Column) -> Column:
    return (F.length(initials) >= 2) & (short != "") & (F.length(short) <= 15) & short.startswith(initials)


def logit(p: Column) -> Column:
    x = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.ln(x / (1 - x))
