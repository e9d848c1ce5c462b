"""Row-level normalisation: Column in, Column out. No UDFs, so everything stays in generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as K

# ---- fixed values: text patterns ------------------------------------------------------------------------------------
INTEGER = r"\A-?[0-9]+\z"
ISO_DATE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
ISO_TOKEN = r"(?<![0-9])([0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9])"
TENTHS = r"\A([0-4](\.[0-9])?|5(\.0)?)\z"
SPACES = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
          "\u2028\u2029\u202f\u205f\u3000")
FORMULA_CELL = r"\A[\s\p{Z}\x{FEFF}]*[=+@-]|\A[\t\r\n]"
# ---- end of fixed values --------------------------------------------------------------------------------------------

C = Column | str


def col(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: C) -> Column:
    c = col(c)
    return c.isNull() | (c == "")


def text(c: C) -> Column:
    """The cell as text with a missing cell as the empty string."""
    return F.coalesce(col(c), F.lit(""))


def null_if_blank(c: C) -> Column:
    """Only the empty cell becomes NULL; nothing is trimmed."""
    return F.nullif(col(c), F.lit(""))


def strict_int(c: C, kind: str = "bigint") -> Column:
    """Base-10 integer text only: no spaces, no plus sign; anything else is NULL."""
    c = col(c)
    return F.when(c.rlike(INTEGER), c.try_cast(kind))


def strict_bool(c: C) -> Column:
    c = col(c)
    true = [k for k, v in K.BOOLEANS.items() if v]
    false = [k for k, v in K.BOOLEANS.items() if not v]
    return F.when(c.isin(true), True).when(c.isin(false), False)


def state_enum(c: C, domain: Sequence[str], rename: Mapping[str, str] | None = None) -> Column:
    """Keep values of the domain, rename the listed ones, NULL for the rest."""
    c = col(c)
    out = F.when(c.isin(list(domain)), c)
    for old, new in (rename or {}).items():
        out = F.when(c == old, F.lit(new)).otherwise(out)
    return out


def mapped(
    c: C, dataset: C, values: Mapping[str, Mapping[str, str]], prefixes: Mapping[str, Mapping[str, str]] | None = None,
) -> Column:
    """Source-specific mapping: exact values or prefixes per dataset; blank is NULL, everything else ``unmapped``."""
    c, dataset = col(c), col(dataset)
    chain = F.when(is_blank(c), None)
    for name, pairs in (prefixes or {}).items():
        for prefix, status in pairs.items():
            chain = chain.when((dataset == name) & c.startswith(prefix), F.lit(status))
    for name, pairs in values.items():
        by_status: dict[str, list[str]] = {}
        for raw, status in pairs.items():
            by_status.setdefault(status, []).append(raw)
        for status, raws in by_status.items():
            chain = chain.when((dataset == name) & c.isin(raws), F.lit(status))
    return chain.otherwise("unmapped")


def prefix_map(c: C, rules: Mapping[str, Mapping[str, str]], by: C = "source_dataset") -> Column:
    return mapped(c, by, {}, rules)


def value_map(c: C, values: Mapping[str, Mapping[str, str]], by: C = "source_dataset") -> Column:
    return mapped(c, by, values)


def detail_status(c: C = "detail_completeness", by: C = "source_dataset") -> Column:
    return mapped(c, by, K.DETAIL_VALUES, K.DETAIL_PREFIXES)


def research_status(c: C = "research_activity_level", by: C = "source_dataset") -> Column:
    return mapped(c, by, K.RESEARCH_LEVEL_VALUES)


def with_raw_companion(df: DataFrame, raw: str, status: Column) -> DataFrame:
    """Replace a lossy column by the pair ``<raw>_status`` and ``<raw>_raw``."""
    return (df.withColumn(f"{raw}_status", status)
              .withColumn(f"{raw}_raw", null_if_blank(raw)).drop(raw))


def iso_date(c: C) -> Column:
    """Calendar date from exactly ``yyyy-MM-dd``, otherwise NULL."""
    c = col(c)
    return F.when(c.rlike(ISO_DATE), F.try_to_date(c, "yyyy-MM-dd"))


def date_status(c: C) -> Column:
    """not_applicable / parsed / partial / unparsed for a raw date or period text."""
    c = col(c)
    tokens = F.regexp_extract_all(c, F.lit(ISO_TOKEN), F.lit(1))
    some_date = F.exists(tokens, lambda t: F.try_to_date(t, "yyyy-MM-dd").isNotNull())
    return (F.when(is_blank(c), "not_applicable")
             .when(c.rlike(ISO_DATE), F.when(iso_date(c).isNotNull(), "parsed").otherwise("unparsed"))
             .when(some_date, "partial").otherwise("unparsed"))


def to_tenths(c: C) -> Column:
    """Decimal text 0..5 with at most one decimal place as integer tenths, exactly; otherwise NULL."""
    c = col(c)
    return F.when(c.rlike(TENTHS), (c.try_cast("decimal(3,1)") * 10).cast("int"))


def leading_space(c: C) -> Column:
    """Does the text start with a space of any kind; trimming looks at no more than the ends of the text."""
    return F.ltrim(col(c), F.lit(SPACES)) != col(c)


def trailing_space(c: C) -> Column:
    return F.rtrim(col(c), F.lit(SPACES)) != col(c)


def padded(c: C) -> Column:
    return F.btrim(col(c), F.lit(SPACES)) != col(c)


def family(c: C = "selection_category") -> Column:
    c = col(c)
    out = F.lit("other")
    for prefix, name in K.FAMILY_PREFIXES.items():
        out = F.when(c.startswith(prefix), F.lit(name)).otherwise(out)
    return out


def labels_where(pairs: Sequence[tuple[C | Column, str]]) -> Column:
    """Ordered array of the labels whose condition holds."""
    return F.array_compact(F.array(*[F.when(col(cond), F.lit(label)) for cond, label in pairs]))


def method_labels() -> Column:
    return labels_where([(F.col(c) == "Yes", label) for c, label in K.METHOD_LABELS])


def condition_labels() -> Column:
    return labels_where([(F.col(c) == v, label) for c, v, label in K.CONDITION_LABELS])


def flag_rules(columns: Sequence[C], rules: Mapping[str, tuple[str, str | None]]) -> list[Column]:
    """One boolean per rule over the joined text: the include pattern matches and the exclude pattern does not."""
    joined = F.concat_ws(" ", *[text(c) for c in columns])
    out = []
    for name, (include, exclude) in rules.items():
        hit = joined.rlike(include)
        out.append((hit & ~joined.rlike(exclude) if exclude else hit).alias(name))
    return out


def special_flags(category: C = "selection_category", name: C = "selection_name", slot: C = "slot_type") -> list[Column]:
    """The five derived flags (Yes/No text). Later corrections win over the broad hit, as in the published rules."""
    category, name, slot = text(category), text(name), text(slot)
    joined = F.concat_ws(" ", category, name, slot)

    # ---- fixed values: words that decide a flag
    ib_word, ib_slot, ib_name = "国際バカロレア", "IBDP利用|IB方式|IB選抜|IB入試", r"\bIB\b"
    two_way_slot, two_way_name = "SAT/ACT方式", "SAT/ACT・IB入試"
    ib_within = "IB.*内数|内数.*IB"
    foreign_word, returnee_word, adult_word, within_word = "私費外国人留学生", "帰国", "社会人", "内数"
    regional_words = "地域枠|地域特別枠|地域推薦|県内募集枠|県外募集枠|県内枠|県外枠|県内推薦|県外推薦"
    regional_within = "一般枠.*(地域枠|地域特別枠).*内数"
    # ---- end of fixed values

    two_way = slot.contains(two_way_slot)
    ib = (joined.contains(ib_word) | slot.rlike(ib_slot) | (name.rlike("(?U)" + ib_name) & ~two_way))
    ib = ib & ~(name.contains(two_way_name) & two_way) & ~slot.rlike(ib_within)
    regional = joined.rlike(regional_words) & ~slot.rlike(regional_within)
    adult = joined.contains(adult_word) & ~(
        slot.contains(within_word) & slot.contains(adult_word) & ~slot.startswith(adult_word))
    flags = {
        "international_baccalaureate_flag": ib,
        "private_foreign_student_flag": joined.contains(foreign_word),
        "returnee_flag": joined.contains(returnee_word),
        "regional_quota_flag": regional,
        "adult_selection_flag": adult,
    }
    return [F.when(hit, "Yes").otherwise("No").alias(flag) for flag, hit in flags.items()]


def evolve(df: DataFrame, after: str, new_cols: Mapping[str, Column]) -> DataFrame:
    """Insert columns behind ``after``; columns that are already there keep place and content."""
    fresh = [c.alias(n) for n, c in new_cols.items() if n not in df.columns]
    at = df.columns.index(after) + 1
    return df.select(*df.columns[:at], *fresh, *df.columns[at:])


def guard_cell(c: C) -> Column:
    """Prefix a quote to text a spreadsheet would run as a formula."""
    c = text(c)
    return F.when(c.rlike(FORMULA_CELL), F.concat(F.lit("'"), c)).otherwise(c)


def shard_of(key: Sequence[C], shards: C | int) -> Column:
    """Shard number: first 8 bytes of SHA-256 over the key's JSON array text, modulo the number of shards."""
    n = F.lit(shards) if isinstance(shards, int) else col(shards)
    payload = F.to_json(F.array(*[col(k).cast("string") for k in key]))
    head = F.conv(F.substring(F.sha2(payload, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return F.pmod(head, n.cast("decimal(20,0)")).cast("bigint")
