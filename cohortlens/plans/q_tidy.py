"""Queries: tidy layer (PRJ, JOIN, SET, RSH) and checks (V) on the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import checks as C
from cohortlens.operators import tidy as TD
from cohortlens.plans.registry import register, rounded
from cohortlens.sources import tables as V
from cohortlens.sources.tables import with_views


def _smap(spark, sf):
    return TD.session_map(V.idmap(spark, sf))


_SMAP_SQL = ("SELECT regexp_replace(participant_id, '^sub-', '') AS subject, "
             "regexp_replace(session_id, '^ses-', '') AS session FROM idmap")


@register("prj_strip_prefix", with_views(_SMAP_SQL, "idmap"))
def q_strip_prefix(spark, sf):
    """SRC1+PRJ1: participant/session map without 'sub-'/'ses-' prefixes."""
    return _smap(spark, sf)


@register("join_session_lookup", rounded(with_views(f"""
SELECT f.subject, s.session, f.acctbal FROM features_wide f JOIN ({_SMAP_SQL}) s ON f.subject = s.subject""",
                                                    "idmap", "features_wide"), ["acctbal"]))
def q_session_lookup(spark, sf):
    """JOIN9: attach each subject's session."""
    f = V.features_wide(spark, sf).select("subject", "acctbal")
    return TD.lookup_session(f, _smap(spark, sf)).select("subject", "session", "acctbal")


_DIAG = "element_at(array('hc', 'mci', 'dem', 'other'), CAST(o_orderkey % 4 AS INT) + 1)"


def _coded_orders(spark, sf):
    o = V.table(spark, sf, "orders")
    return o.select("o_orderkey", F.col("o_orderstatus").alias("sex"),
                    F.expr(_DIAG).alias("diagnosis"))


@register("prj_recode", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderstatus = 'M' THEN 1 END AS sex,
       CASE WHEN d = 'hc' THEN 0 WHEN d = 'mci' THEN 1 WHEN d = 'dem' THEN 2 END AS diagnosis
FROM (SELECT o_orderkey, o_orderstatus, ['hc', 'mci', 'dem', 'other'][CAST(o_orderkey % 4 AS INTEGER) + 1] AS d
      FROM orders)""")
def q_recode(spark, sf):
    """PRJ2+PRJ3: recode sex and diagnosis strings to numbers (unmapped -> NULL)."""
    return TD.recode_diagnosis(TD.recode_sex(_coded_orders(spark, sf), "sex"), "diagnosis")


@register("chk_domain", """
SELECT o_orderstatus AS sex, count(*) AS n FROM orders
WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'M') GROUP BY o_orderstatus""")
def q_domain(spark, sf):
    """V6: values outside the recoding domain, counted."""
    bad = C.outside_domain(_coded_orders(spark, sf), "sex", list(TD.SEX_CODES))
    return bad.groupBy("sex").agg(F.count(F.lit(1)).alias("n"))


# structural-statistics names -------------------------------------------------

def _stats_long(spark, sf):
    s = V.stats(spark, sf)
    return s.select("subject", F.concat("struct", F.lit("&vol")).alias("name"), "value", "struct")


@register("prj_select_measures", rounded(with_views("""
SELECT subject, 'fs__subcortVolume__' || replace(struct || '&vol', '&', '_') AS name, value
FROM stats WHERE struct IN ('AF', 'NF', 'RF', 'eTIV') AND struct NOT IN ('eTIV')""", "stats"), ["value"]))
def q_select_measures(spark, sf):
    """PRJ4+PRJ5+PRJ6+PRJ8: keep listed measures, drop eTIV, sanitize and prefix names."""
    long = TD.select_names(_stats_long(spark, sf), ["AF", "NF", "RF", "eTIV"], "struct")
    long = TD.drop_names(long, ["eTIV"], "struct")
    long = long.withColumn("name", TD.sanitize_names("name"))
    return TD.prefix_names(long, "fs__subcortVolume__").select("subject", "name", "value")


_TABLE_OF = ("CASE substr(struct, 1, 1) WHEN 'A' THEN 'subcortVolume' WHEN 'N' THEN 'globalVolume' "
             "ELSE 'cortVolume' END")


@register("prj_filter_regex", rounded(with_views(f"""
SELECT subject, name, value FROM (
  SELECT subject, 'fs__' || {_TABLE_OF} || '__' || struct AS name, value FROM stats WHERE struct <> 'eTIV')
WHERE regexp_matches(name, 'subcor|glob')""", "stats"), ["value"]))
def q_filter_regex(spark, sf):
    """PRJ7: keep feature names matching 'subcor|glob' (unanchored)."""
    s = V.stats(spark, sf).filter("struct <> 'eTIV'")
    long = s.select("subject", F.concat(F.lit("fs__"), F.expr(_TABLE_OF), F.lit("__"), "struct").alias("name"),
                    "value")
    return TD.filter_names_regex(long, "subcor|glob")


# gaps, missing indicators, checks ------------------------------------------------

_FEATS = ["acctbal", "price_F", "price_O", "price_P"]


@register("prj_fillna_missing", rounded(with_views("""
SELECT subject, acctbal,
       coalesce(price_F, -999.0) AS price_F, coalesce(price_O, -999.0) AS price_O,
       coalesce(price_P, -999.0) AS price_P,
       coalesce(price_F, 999.0) AS price_F_missing, coalesce(price_O, 999.0) AS price_O_missing,
       coalesce(price_P, 999.0) AS price_P_missing
FROM features_wide""", "features_wide"),
    ["acctbal", "price_F", "price_O", "price_P", "price_F_missing", "price_O_missing", "price_P_missing"]))
def q_fillna_missing(spark, sf):
    """PRJ13: NULL -> -999 plus {c}_missing twins for columns with gaps."""
    return TD.fillna_missing_in_attributes(V.features_wide(spark, sf))


@register("agg_any_missing", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) > 0 AS any_missing, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM features_wide" for c in _FEATS), "features_wide"))
def q_any_missing(spark, sf):
    """AGG5: per column, whether (and how often) it is missing."""
    return TD.any_missing(V.features_wide(spark, sf), _FEATS)


@register("chk_missings", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\" FROM features_wide HAVING count(*) FILTER (WHERE {c} IS NULL) > 0"
    for c in _FEATS if c != "price_P"), "features_wide"))
def q_check_missings(spark, sf):
    """V1: columns with gaps that are not allow-listed (allowed: price_P)."""
    return C.missing_outside_allowed(V.features_wide(spark, sf), ["price_P"])


# joins and unions on subject -----------------------------------------------------

def _status_table(spark, sf, status, col="price"):
    o = V.table(spark, sf, "orders").filter(F.col("o_orderstatus") == status)
    return o.groupBy(F.col("o_custkey").cast("string").alias("subject")).agg(F.avg("o_totalprice").alias(col))


def _status_sql(status, col="price"):
    return (f"SELECT CAST(o_custkey AS VARCHAR) AS subject, avg(o_totalprice) AS {col} FROM orders "
            f"WHERE o_orderstatus = '{status}' GROUP BY o_custkey")


@register("join_concat_modalities", rounded(f"""
SELECT coalesce(a.subject, b.subject) AS subject, a.price AS ordF__price, b.price AS ordP__price
FROM ({_status_sql('F')}) a FULL OUTER JOIN ({_status_sql('P')}) b ON a.subject = b.subject""",
                                            ["ordF__price", "ordP__price"]))
def q_concat_modalities(spark, sf):
    """JOIN1+PRJ6: full outer join of two prefixed feature tables on subject."""
    return TD.concat_modalities([_status_table(spark, sf, "F"), _status_table(spark, sf, "P")], ["ordF", "ordP"])


@register("set_stack", rounded(f"""
SELECT price_F, NULL::DOUBLE AS price_O, subject FROM ({_status_sql('F', 'price_F')})
UNION ALL SELECT NULL::DOUBLE AS price_F, price_O, subject FROM ({_status_sql('O', 'price_O')})""",
                               ["price_F", "price_O"]))
def q_stack(spark, sf):
    """SET1+SRT2: vertical union by name, missing columns NULL, sorted columns."""
    return TD.stack([_status_table(spark, sf, "F", "price_F"), _status_table(spark, sf, "O", "price_O")])


@register("chk_duplicate_keys", f"""
SELECT subject, count(*) AS n FROM (
  SELECT subject FROM ({_status_sql('F')}) UNION ALL SELECT subject FROM ({_status_sql('O')}))
GROUP BY subject HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf):
    """SET2/V5: subjects occurring in both stacked tables."""
    st = TD.stack([_status_table(spark, sf, "F"), _status_table(spark, sf, "O")])
    return C.duplicate_keys(st, ["subject"])


def _requested(spark, sf):
    c = V.table(spark, sf, "customer").filter(F.col("c_nationkey") < 10)
    return c.select(F.col("c_custkey").cast("string").alias("subject"), F.col("c_custkey").alias("pos"))


_REQ_SQL = "SELECT CAST(c_custkey AS VARCHAR) AS subject, c_custkey AS pos FROM customer WHERE c_nationkey < 10"


@register("join_semi_requested", f"""
SELECT r.subject FROM ({_REQ_SQL}) r WHERE r.subject IN (SELECT subject FROM ({_status_sql('P')}))""")
def q_semi(spark, sf):
    """JOIN5: requested subjects that have features."""
    return TD.semi(_requested(spark, sf).select("subject"), _status_table(spark, sf, "P"))


@register("chk_missing_requested", f"""
SELECT r.subject FROM ({_REQ_SQL}) r WHERE r.subject NOT IN (SELECT subject FROM ({_status_sql('P')}))""")
def q_missing_requested(spark, sf):
    """V2/SET4: requested subjects without features."""
    return C.missing_keys(_requested(spark, sf), _status_table(spark, sf, "P"))


@register("prj_filter_rows", rounded(with_views(f"""
SELECT f.subject, r.pos, f.acctbal FROM features_wide f JOIN ({_REQ_SQL}) r ON f.subject = r.subject""",
                                                "features_wide"), ["acctbal"]))
def q_filter_rows(spark, sf):
    """PRJ15: requested rows with their request position (order by pos to restore)."""
    f = V.features_wide(spark, sf).select("subject", "acctbal")
    return TD.filter_rows(f, _requested(spark, sf)).select("subject", "pos", "acctbal")


@register("prj_exclude_subjects", rounded(with_views("""
SELECT subject, acctbal FROM features_wide WHERE subject NOT IN (
  SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')""", "features_wide"),
    ["acctbal"]))
def q_exclude(spark, sf):
    """PRJ17: drop an exclusion list of subjects (left anti join)."""
    ex = V.table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").cast("string").alias("subject"))
    return TD.exclude(V.features_wide(spark, sf).select("subject", "acctbal"), ex)


@register("join_attach_truth", rounded(with_views("""
SELECT p.subject, p.modality, p.split, p.price_pred, t.order_total, p.weight
FROM pred p LEFT JOIN (SELECT CAST(o_orderkey AS VARCHAR) AS subject, o_totalprice AS order_total FROM orders) t
  ON p.subject = t.subject""", "pred"), ["price_pred", "order_total", "weight"]))
def q_attach_truth(spark, sf):
    """JOIN4/JOIN7: predictions left-joined with truth per subject."""
    p = V.pred(spark, sf).select("subject", "modality", "split", "price_pred", "weight")
    truth = V.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("subject"),
                                                 F.col("o_totalprice").alias("order_total"))
    return TD.left_align(p, truth).select("subject", "modality", "split", "price_pred", "order_total", "weight")


@register("chk_unaligned_keys", with_views("""
SELECT coalesce(x.subject, y.subject) AS subject, CASE WHEN x.subject IS NULL THEN 'y_only' ELSE 'x_only' END AS side
FROM (SELECT DISTINCT subject FROM features_wide) x
FULL OUTER JOIN (SELECT DISTINCT subject FROM (""" + _status_sql("P") + """)) y ON x.subject = y.subject
WHERE x.subject IS NULL OR y.subject IS NULL""", "features_wide"))
def q_unaligned(spark, sf):
    """V7: subjects present in X (features) but not in y (targets), or vice versa."""
    return C.unaligned_keys(V.features_wide(spark, sf), _status_table(spark, sf, "P"))


# ---------------------------------------------------------------- PRJ9, PRJ19 on table-derived inputs

_ORDER = ["A", "N", "R", "F", "O"]


def _modalities(spark, sf):
    li = V.table(spark, sf, "lineitem")
    from cohortlens.operators.ranking import rank_within
    mods = li.select(F.concat_ws(" + ", "l_returnflag", "l_linestatus").alias("modality")).distinct()
    # position in sorted order; the checked rank spreads the set if it were ever large
    ranked = rank_within(mods.withColumn("__g", F.lit(0)), ["__g"], [F.col("modality")], "__rn")
    return ranked.select((F.col("__rn") - 1).cast("int").alias("pos"), "modality")


@register("prj_modality_membership", f"""
WITH m AS (SELECT DISTINCT l_returnflag || ' + ' || l_linestatus AS modality FROM lineitem),
p AS (SELECT CAST(row_number() OVER (ORDER BY modality) - 1 AS INTEGER) AS pos, modality FROM m)
SELECT pos, modality, {", ".join(f"CASE WHEN list_contains(string_split(modality, ' + '), '{o}') THEN pos + 1 ELSE 0 END AS {o}" for o in _ORDER)}
FROM p""")
def q_membership(spark, sf):
    """PRJ19: per modality string (sorted position i) and part: i+1 if a member, else 0."""
    return TD.modality_membership(_modalities(spark, sf), _ORDER)


# ---------------------------------------------------------------- RSH6, RSH8

_SIDE = 8      # an embedding of 64 values as an 8 x 8 matrix


@register("rsh_matrix_to_long", rounded(f"""
SELECT vec_id, CAST(k // {_SIDE} AS INTEGER) AS i, CAST(k % {_SIDE} AS INTEGER) AS j, value FROM (
  SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS k, CAST(unnest(embedding) AS DOUBLE) AS value
  FROM embeddings) x""", ["value"]))
def q_matrix(spark, sf):
    """RSH6: every embedding as a matrix of rows of 8, in long form."""
    emb = V.table(spark, sf, "embeddings")
    starts = F.sequence(F.lit(1), F.size("embedding"), F.lit(_SIDE))
    rows = F.transform(starts, lambda at: F.slice(F.col("embedding"), at, F.lit(_SIDE)))
    m = emb.select("vec_id", rows.cast("array<array<double>>").alias("matrix"))
    return TD.matrix_to_long(m, keys=["vec_id"])


@register("rsh_flatten_list", r"""
SELECT doc_id, md5(array_to_string(flatten(list_transform(string_split(text, chr(10)),
                                                          lambda x: string_split(x, ' '))), '|')) AS words
FROM documents""")
def q_flatten(spark, sf):
    """RSH8: the words of every line of a text, flattened to one list (digest)."""
    lines = F.transform(F.split("text", "\n"), lambda line: F.split(line, " "))
    nested = V.table(spark, sf, "documents").select("doc_id", lines.alias("nested"))
    return nested.select("doc_id", F.md5(F.array_join(TD.flatten_list("nested"), "|")).alias("words"))
