"""Cleaning of record tables: 17 name columns, 18 address columns and their flags, script counts."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from entres.functions import text as T
from entres.functions import unicode as U

from .steps import step

NAME_COLUMNS = [
    "name_translit", "name_core", "name_tokens_sorted", "has_legal_suffix", "name_token_count", "name_compact", "name_char_len", "name_first_token", "name_last_token", "name_initials",
    "name_has_digit", "name_numeric_tokens", "name_alnum_tokens", "name_skeleton", "has_alias", "name_primary", "name_alias",
]
COMPONENTS = ["house_number", "unit_number", "floor_number", "plot_number", "sector", "phase", "block", "street_name", "landmark", "address_core"]
ADDRESS_COLUMNS = ["address_clean", "address_pin", "address_tokens_sorted", "has_state_token", *COMPONENTS, "address_token_count", "address_char_len", "address_numeric_tokens", "address_numeric_count"]

# ---------------------------------------------------------------- fixed values: canonical words of addresses
ABBREVIATIONS = {
    canonical: spellings.split()
    for canonical, spellings in {
        "rd": "road rd", "st": "street st str saint sainte", "ave": "avenue ave av", "blvd": "boulevard blvd boul bd bld", "ln": "lane ln", "dr": "drive dr", "ct": "court ct", "cir": "circle cir", "pl": "place pl",
        "sq": "square sq", "hwy": "highway hwy", "pkwy": "parkway pkwy", "ter": "terrace ter", "trl": "trail trl", "expy": "expressway expy", "fwy": "freeway fwy", "ste": "suite ste",
        "apt": "apartment apartments apt appartement appt", "bldg": "building bldg bhawan bhavan batiment bat", "fl": "floor flr fl etage", "no": "number no num nos", "blk": "block blk", "opp": "opposite opp",
        "ctr": "center centre ctr", "mt": "mount mt", "ft": "fort ft", "pt": "point pt", "hts": "heights hts", "n": "north", "s": "south", "e": "east", "w": "west", "ne": "northeast", "nw": "northwest",
        "se": "southeast", "sw": "southwest", "hno": "house hno hn", "plot": "plot plt", "sector": "sector sec", "phase": "phase", "po": "post po", "dist": "district dist", "kh": "khasra kh", "rue": "rue",
        "imp": "impasse imp", "chem": "chemin chem", "rte": "route rte", "quai": "quai", "res": "residence res", "fbg": "faubourg fbg",
    }.items()
}
ABBREVIATION_OF = {s: c for c, ss in ABBREVIATIONS.items() for s in ss}
#: Regions by code, of the United States, India and France; a later one of the same name wins.
REGIONS = {
    name: code
    for code, names in [
        *[x.split(":") for x in "al:alabama ak:alaska az:arizona ar:arkansas ca:california co:colorado ct:connecticut de:delaware fl:florida ga:georgia hi:hawaii id:idaho il:illinois in:indiana ia:iowa ks:kansas ky:kentucky la:louisiana me:maine md:maryland ma:massachusetts mi:michigan mn:minnesota ms:mississippi mo:missouri mt:montana ne:nebraska nv:nevada nh:new_hampshire nj:new_jersey nm:new_mexico ny:new_york nc:north_carolina nd:north_dakota oh:ohio ok:oklahoma or:oregon pa:pennsylvania ri:rhode_island sc:south_carolina sd:south_dakota tn:tennessee tx:texas ut:utah vt:vermont va:virginia wa:washington wv:west_virginia wi:wisconsin wy:wyoming dc:district_of_columbia".split()],
        *[x.split(":") for x in "ap:andhra_pradesh,andhra_pradesa ar:arunachal_pradesh as:assam,asama br:bihar,bihara cg:chhattisgarh,chhattisagadha,chattisgarh ga:goa gj:gujarat,gujarata hr:haryana,hariyana hp:himachal_pradesh,himachala_pradesa jh:jharkhand,jharakhanda ka:karnataka,karnatak kl:kerala,keralam mp:madhya_pradesh,madhya_pradesa mh:maharashtra,maharastra mn:manipur,manipura ml:meghalaya mz:mizoram nl:nagaland od:odisha,orissa,odisa pb:punjab,pamjaba,panjaba rj:rajasthan,rajasthana sk:sikkim tn:tamil_nadu,tamilnadu,dhamilnadhu,tamila_nadu tg:telangana,telamgana tr:tripura up:uttar_pradesh,uttara_pradesa uk:uttarakhand,uttarakhanda,uttaranchal wb:west_bengal,pascimavanga,pascimabangg,pascima_bangala dl:delhi,new_delhi,dilli jk:jammu_and_kashmir la:ladakh py:puducherry,pondicherry ch:chandigarh".split()],
        *[x.split(":") for x in "idf:ile_de_france ara:auvergne_rhone_alpes naq:nouvelle_aquitaine occ:occitanie hdf:hauts_de_france pac:provence_alpes_cote_d_azur,provence_alpes_cote_dazur,paca ges:grand_est pdl:pays_de_la_loire nor:normandie bre:bretagne bfc:bourgogne_franche_comte cvl:centre_val_de_loire cor:corse".split()],
    ]
    for name in names.replace("_", " ").split(",")
}
JUNK_WORDS = ["null", "nan", "none", "cedex", "bis"]
LABELS = {"hno": "house_number", "plot": "plot_number", "kh": "plot_number", "sector": "sector", "phase": "phase", "blk": "block", "apt": "unit_number", "ste": "unit_number"}
BEFORE_NO = {**dict.fromkeys(["shop", "flat", "door", "office", "unit", "room"], "unit_number"), **dict.fromkeys(["house", "building", "bldg"], "house_number")}
STREETS = set("rd st ave blvd ln dr ct cir pl sq hwy pkwy ter trl expy fwy rue imp chem rte quai".split())
LANDMARKS = set("near opp behind beside adjacent next infront front above below close backside".split())
_NUMBER = re.compile(r"\d+[a-z]?|[a-z]-?\d+[a-z]?")
_BLOCK = re.compile(r"[a-z0-9]{1,3}")
_FLOOR = re.compile(r"(\d+)(?:st|nd|rd|th)?")


def clean_names(df: DataFrame, name: str = "business_name") -> DataFrame:
    """``df`` with the 17 name columns; a null name is empty.  Steps are projections, so that no expression is computed twice."""
    keep = [c for c in df.columns if c not in NAME_COLUMNS]
    x = df.select(*keep, U.repaired(F.coalesce(F.col(name), F.lit(""))).alias("__t"))
    x = step(x, __t=F.regexp_replace(F.split_part("__t", F.lit("|"), F.lit(1)), r"^[\s\-]+", ""))
    x = step(x, __script=T.non_latin("__t"), __t=F.when(T.non_ascii("__t"), F.col("__t")).otherwise(T.case_lookalikes("__t")))
    x = x.withColumn("__t", U.romanised(T.alias_marks(T.web_names("__t"))))
    x = step(x, __all=T.name_tokens(T.apostrophes("__t")))
    x = step(x, __all=T.collapsed(F.col("__all")))
    # the first alias mark with words on both sides: from, to
    n, at = F.size("__all"), lambda i: F.get(F.col("__all"), i)

    def mark(i):
        pair = ((at(i) == "trading") & (at(i + 1) == "as")) | (at(i).isin("also", "formerly") & (at(i + 1) == "known"))
        to = F.when(pair, i + 2 + F.coalesce((at(i + 2) == "as").cast("int"), F.lit(0))).when(at(i).isin("dba", "aka", "fka", "formerly"), i + 1)
        return F.struct(i.alias("a"), F.when((i > 0) & (to < n), to).alias("b"))

    marks = F.filter(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), mark), lambda m: m.b.isNotNull())
    x = step(x, __m=F.get(marks, F.lit(0)))
    single = lambda t: t.isin("dba", "aka", "fka")
    inside = lambda i: F.coalesce((i >= F.col("__m.a")) & (i < F.col("__m.b")), F.lit(False))
    script, parts = F.col("__script"), ("__body", "__first", "__second")
    x = step(
        x, __body=F.filter("__all", lambda t, i: ~single(t) & ~inside(i)), __first=F.filter("__all", lambda t, i: ~single(t) & F.coalesce(i < F.col("__m.a"), F.lit(False))),
        __second=F.filter("__all", lambda t, i: ~single(t) & F.coalesce(i >= F.col("__m.b"), F.lit(False))),
    )
    x = step(x, **{f"{c}_s": T.sounded(F.col(c)) for c in parts})
    x = step(x, **{f"{c}_k": T.without_legal(F.col(f"{c}_s"), script) for c in parts})
    x = step(x, __core=T.core(F.col("__body_s"), F.col("__body_k"), script), **{c: T.core(F.col(f"{c}_s"), F.col(f"{c}_k"), script) for c in parts[1:]})
    body, core = F.col("__body"), F.col("__core")
    alias = F.size("__second") > 0
    compact = T.joined(core, "")
    has_digit = F.exists(core, lambda t: t.rlike("[0-9]"))
    first = lambda i: F.coalesce(F.try_element_at(core, F.lit(i)), F.lit(""))
    return x.select(
        *keep, T.joined(body).alias("name_translit"), T.joined(core).alias("name_core"), T.joined(F.array_sort(core)).alias("name_tokens_sorted"), (F.size(core) < F.size(body)).alias("has_legal_suffix"),
        F.size(core).alias("name_token_count"), compact.alias("name_compact"), F.length(compact).alias("name_char_len"), first(1).alias("name_first_token"), first(-1).alias("name_last_token"),
        T.joined(F.transform(core, lambda t: F.substr(t, F.lit(1), F.lit(1))), "").alias("name_initials"), has_digit.alias("name_has_digit"),
        T.joined(F.filter(core, T.is_digits), ",").alias("name_numeric_tokens"), T.joined(F.filter(core, lambda t: t.rlike("[0-9]") & ~T.is_digits(t)), ",").alias("name_alnum_tokens"),
        T.joined(F.array_sort(F.filter(F.transform(core, T.skeleton), lambda s: s != "")), "").alias("name_skeleton"), alias.alias("has_alias"),
        F.when(alias, T.joined("__first")).otherwise("").alias("name_primary"), F.when(alias, T.joined("__second")).otherwise("").alias("name_alias"),
    )


def components(tokens: list[str]) -> dict[str, str]:
    """Labelled parts of an address; empty where unsure."""
    out = dict.fromkeys(COMPONENTS, "")
    n, free = len(tokens), [True] * len(tokens)

    def claim(field: str, value: str, *places: int) -> None:
        out[field] = value
        for p in places:
            free[p] = False

    def usable(i: int) -> bool:
        return 0 <= i < n and free[i]

    for i, t in enumerate(tokens):
        field = LABELS.get(t)
        if field is not None and not out[field]:
            j = i + 1 + (i + 1 < n and tokens[i + 1] == "no")
            if usable(j) and (_BLOCK if field == "block" else _NUMBER).fullmatch(tokens[j]):
                claim(field, tokens[j], *range(i, j + 1))
        elif t == "fl" and not out["floor_number"]:
            for j in (i - 1, i + 1):
                m = _FLOOR.fullmatch(tokens[j]) if usable(j) else None
                if m:
                    claim("floor_number", m[1], i, j)
                    break
        elif t == "no" and free[i] and i > 0 and usable(i - 1) and tokens[i - 1] in BEFORE_NO:
            field = BEFORE_NO[tokens[i - 1]]
            if not out[field] and usable(i + 1) and _NUMBER.fullmatch(tokens[i + 1]):
                claim(field, tokens[i + 1], i - 1, i, i + 1)
    start = next((i for i, t in enumerate(tokens) if t in LANDMARKS and free[i]), n)
    stop = min(start + 1, n)
    while stop < min(start + 5, n) and free[stop] and tokens[stop] not in LANDMARKS and tokens[stop] not in LABELS:
        stop += 1
    claim("landmark", " ".join(tokens[start:stop]), *range(start, stop))
    if not out["house_number"] and usable(0):
        if _NUMBER.fullmatch(tokens[0]):
            claim("house_number", tokens[0], 0)
        elif len(tokens[0]) == 1 and tokens[0].isalpha() and usable(1) and tokens[1].isdigit():
            claim("house_number", tokens[0] + tokens[1], 0, 1)
    i = next((i for i, t in enumerate(tokens) if t in STREETS and free[i]), None)
    if i is not None:
        j = i
        while i - j < 2 and usable(j - 1) and len(tokens[j - 1]) > 1 and not _NUMBER.fullmatch(tokens[j - 1]) and tokens[j - 1] not in LABELS and tokens[j - 1] not in STREETS:
            j -= 1
        if j < i:
            out["street_name"] = " ".join(tokens[j : i + 1])
    out["address_core"] = " ".join(tokens[:start] + tokens[stop:])
    return out


@pandas_udf(StructType([StructField(c, StringType()) for c in COMPONENTS]))
def address_components(tokens: pd.Series) -> pd.DataFrame:
    known: dict[str, dict] = {}
    rows = [known[t] if t in known else known.setdefault(t, components(t.split())) for t in tokens]
    return pd.DataFrame(rows, columns=COMPONENTS)


_REGION = re.compile(rf"\b(?:{'|'.join(sorted(REGIONS, key=len, reverse=True))})\b")


@pandas_udf(StructType([StructField("text", StringType()), StructField("found", BooleanType())]))
def region_codes(text: pd.Series) -> pd.DataFrame:
    """Names of regions become their codes, the longest name first; whether there was one."""
    out = text.map(lambda t: _REGION.sub(lambda m: REGIONS[m[0]], t))
    return pd.DataFrame({"text": out, "found": text.map(lambda t: _REGION.search(t) is not None)})


def clean_addresses(df: DataFrame, address: str = "business_address") -> DataFrame:
    """``df`` with the 18 address columns and the flags ``is_missing_address`` and ``has_*``; a null address is empty."""
    flags = [f"has_{c}" for c in ("house_number", "unit_number", "floor_number", "plot_number", "sector", "street_name", "landmark")]
    keep = [c for c in df.columns if c not in {*ADDRESS_COLUMNS, *flags, "is_missing_address", "has_postal_code"}]
    x = df.select(*keep, U.repaired(F.coalesce(F.col(address), F.lit(""))).alias("__t"))
    x = step(x, __t=F.regexp_replace(F.regexp_replace("__t", r"\b[nN]\s*[°º]\s*", " no "), "[°º]", " "))
    x = step(x, __masks=T.masked_numbers("__t"), __t=F.replace("__t", F.lit("#"), F.lit(" ")))
    x = step(x, address_pin=T.postal_code("__t")).withColumn("__t", U.romanised(F.col("__t")))
    x = step(x, __t=T.address_text(T.apostrophes("__t")))
    x = x.withColumn("__t", T.joined(F.filter(T.words("__t"), lambda t: ~t.isin(*JUNK_WORDS))))
    x = x.withColumn("__r", region_codes("__t")).withColumn("has_state_token", F.col("__r.found"))
    x = step(x, __w=F.transform(T.words("__r.text"), lambda t: T.looked_up(t, ABBREVIATION_OF)))
    x = step(x, __w=T.collapsed(F.col("__w")))
    x = step(x, __w=F.concat("__w", F.filter("__masks", lambda m: ~F.array_contains(F.col("__w"), m))))
    x = x.withColumn("address_clean", T.joined("__w")).withColumn("__c", address_components("address_clean"))
    digits = F.array_sort(F.array_distinct(F.filter("__w", T.is_digits)))
    cols = {
        "address_clean": F.col("address_clean"), "address_pin": F.col("address_pin"), "address_tokens_sorted": T.joined(F.array_sort("__w")), "has_state_token": F.col("has_state_token"),
        **{c: F.col(f"__c.{c}") for c in COMPONENTS}, "address_token_count": F.size("__w"), "address_char_len": F.length("address_clean"), "address_numeric_tokens": T.joined(digits, ","), "address_numeric_count": F.size(digits),
        "is_missing_address": F.col("address_clean") == "", **{f: F.col(f"__c.{f[4:]}") != "" for f in flags}, "has_postal_code": F.col("address_pin") != "",
    }
    return x.select(*keep, *[c.alias(n) for n, c in cols.items()])


def clean_records(df: DataFrame) -> DataFrame:
    """A raw entity table as a clean one of 50 columns."""
    df = df.withColumn("source", F.split_part("entity_id", F.lit("-"), F.lit(1)))
    df = df.withColumn("country_clean", F.regexp_replace(F.trim(F.coalesce("country", F.lit(""))), r"\s+", " "))
    return clean_addresses(clean_names(df))


def script_counts(df: DataFrame, column: str) -> DataFrame:
    """One row: texts, texts that are not ASCII, and texts with a character of each script."""
    c = F.col(column)
    has = {name: c.rlike(f"[\\x{{{lo:X}}}-\\x{{{hi:X}}}]") for name, (lo, hi) in T.SCRIPTS.items()}
    other = T.non_ascii(c)
    for h in has.values():
        other = other & ~h
    return df.where(c.isNotNull()).agg(F.count(F.lit(1)).alias("total"), F.count_if(T.non_ascii(c)).alias("non_ascii"), *[F.count_if(h).alias(n) for n, h in has.items()], F.count_if(other).alias("Other-NonASCII"))
