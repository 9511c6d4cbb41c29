"""Queries of the training-text problems (5, 7, 8, 9, 10) and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilovela.llm import canonical, leakage, mixing, stuffing, survivors
from kilovela.functions.normalize import match_key
from kilovela.session import table

Query = Callable[[SparkSession, str], DataFrame]

GEN_KEYS = ["codigo_variable", "fecha_hora", "codigo_duracion", "unidad_medida", "codigo_agente", "codigo_planta"]


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    g = survivors.by_order(table(spark, d, "generacion_real"), GEN_KEYS, "valor", "version", "ingestion_timestamp", "registro_id")
    return g.where(F.col("filas") >= 2).select("grupo_id", "registro_id")


def p5_survivors(spark: SparkSession, d: str) -> DataFrame:
    fields = {"valor": True, "planta_encontrada": False, "agente_encontrado": False}
    return survivors.survivors(table(spark, d, "generacion_real"), GEN_KEYS, fields, "version", "ingestion_timestamp", "registro_id")


def p5_votes(spark: SparkSession, d: str) -> DataFrame:
    """valor by estimated weights alone."""
    g = survivors.survivors(table(spark, d, "generacion_real"), GEN_KEYS, {"valor": False}, "version", "ingestion_timestamp", "registro_id")
    return g.select("grupo_id", "filas", "valor", "registro_valor", "apoyo_valor")


def p5_weights(spark: SparkSession, d: str) -> DataFrame:
    return survivors.lost_shares(table(spark, d, "generacion_real"), GEN_KEYS, ["valor", "planta_encontrada", "agente_encontrado"], "version", "ingestion_timestamp", "registro_id")


TYPED = [("nombre_reservorio", "embalses", "codigo_embalse", "nombre_embalse"), ("nombre_planta", "plantas", "codigo_planta", "nombre_planta")]


def p7_values(spark: SparkSession, d: str) -> DataFrame:
    typed = table(spark, d, "plantas_reservorios")
    out = None
    for column, ref, code, name in TYPED:
        one = canonical.map_values(typed, "relacion_id", column, table(spark, d, ref), code, name).withColumn("campo", F.lit(column))
        out = one if out is None else out.unionByName(one)
    return out


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_values(spark, d).select("relacion_id", "campo", "codigo")


def p7_same_letters(spark: SparkSession, d: str) -> DataFrame:
    """Of the mapping the values that are a reference name but for case, accents, blanks and punctuation: what SQL can check."""
    got, out = p7_values(spark, d), None
    for column, ref, code, name in TYPED:
        keys = table(spark, d, ref).groupBy(match_key(name).alias("k")).agg(F.count("*").alias("n")).where("n = 1")
        one = got.where(F.col("campo") == column).withColumn("k", match_key("valor")).join(F.broadcast(keys), "k")  # the two lists are fixed
        out = one if out is None else out.unionByName(one)
    return out.select("relacion_id", "campo", "codigo")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_scrubbed(spark: SparkSession, d: str) -> DataFrame:
    return leakage.scrub(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_counts(spark: SparkSession, d: str) -> DataFrame:
    """Of the scrubbing the words of each document, how many go, and whether the document goes whole."""
    return p8_scrubbed(spark, d).select("doc_id", "palabras", "filtradas", "descartado")


def p9_targets_met(spark: SparkSession, d: str) -> DataFrame:
    """Whether each source with documents has its share of the tokens by membership within half a point and two of the longest documents, and no document is used too often."""
    s = p9_shares(spark, d)
    there = s.agg(F.sum(F.when(F.col("parte_esperada") > 0, F.col("objetivo"))).alias("_q"))
    ok = (F.abs(F.col("parte_esperada") - F.col("objetivo") / F.col("_q")) <= 0.005 + 2 * F.col("mayor_documento")) & (F.col("mas_copias") <= F.col("max_repeats"))
    return s.crossJoin(F.broadcast(there)).select("source", "objetivo", "max_repeats", (ok | (F.col("parte_esperada") == 0)).alias("cumple"))  # one row


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"), parent="parent_id")[0].drop("p", "cap")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(*mixing.mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"), parent="parent_id"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return stuffing.pages(table(spark, d, "documents")).where("relleno").select("doc_id")


def p10_pages(spark: SparkSession, d: str) -> DataFrame:
    return stuffing.pages(table(spark, d, "documents"))


def p10_plain_cases(spark: SparkSession, d: str) -> DataFrame:
    """Of the flagged pages those that hold nothing but links or nothing but tags, six or more: what SQL can check."""
    t = table(spark, d, "documents").select("doc_id", F.trim("text").alias("t"))
    kind = F.when(F.col("t").rlike(r"(?i)^(https?://\S+\s*){6,}$"), "enlaces").when(F.col("t").rlike(r"^(#\w+[ ,]*){6,}$"), "etiquetas")
    return p10_found(spark, d).join(t.select("doc_id", kind.alias("clase")).where("clase is not null"), "doc_id").select("doc_id", "clase")


QUERIES: dict[str, Query] = {
    "p5_found": p5_found, "p5_survivors": p5_survivors, "p5_votes": p5_votes, "p5_weights": p5_weights, "p7_found": p7_found, "p7_values": p7_values, "p7_same_letters": p7_same_letters, "p8_found": p8_found, "p8_scrubbed": p8_scrubbed, "p8_counts": p8_counts,
    "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p9_targets_met": p9_targets_met, "p10_found": p10_found, "p10_pages": p10_pages, "p10_plain_cases": p10_plain_cases,
}


def _words(c: str) -> str:
    return f"regexp_extract_all(lower(strip_accents({c})), '[\\p{{L}}\\p{{N}}]+')"


def _letters(c: str) -> str:
    return f"regexp_replace(translate(upper({c}), 'ÁÉÍÓÚÜÑ', 'AEIOUUN'), '[^A-Z0-9]+', '', 'g')"


_CLAIMS = """r AS (SELECT *, registro_id AS id, upper(trim(version)) AS ver, dense_rank() OVER (ORDER BY upper(trim(codigo_variable)), fecha_hora,
        upper(trim(codigo_duracion)), upper(trim(unidad_medida)), upper(trim(codigo_agente)), upper(trim(codigo_planta))) AS g FROM generacion_real),
    k AS (SELECT *, coalesce(CASE WHEN ver = 'TXF' THEN 4000000000000000 WHEN ver = 'TXR' THEN 3000000000000000 WHEN regexp_full_match(ver, 'TX[0-9]{1,15}') THEN substr(ver, 3)::BIGINT ELSE -1 END, -1) AS p FROM r),
    s AS (SELECT g, min(id) AS grupo_id, count(*) AS filas FROM k GROUP BY g)"""
_LATE = "(coalesce(ingestion_timestamp, TIMESTAMP '1000-01-01'), id)"


def _truth(field: str, rounds: int = 8) -> str:
    """Claims c_, and after the rounds of voting the weights w_ and winners x_ of a field, as common table expressions."""
    f = field
    out = [
        f"c_{f} AS MATERIALIZED (SELECT g, p, arg_max({f}, {_LATE}) AS v, arg_max(id, {_LATE}) AS id FROM k WHERE {f} IS NOT NULL GROUP BY g, p)",
        f"w0_{f} AS (SELECT DISTINCT p, 1.0::DOUBLE AS w FROM c_{f})",
    ]
    for i in range(rounds + 1):
        best = "arg_max(v, (s, top))"
        more = f", arg_max(id, (s, top)) AS id, max(s) / sum(s) AS parte" if i == rounds else ""
        out.append(f"x{i}_{f} AS MATERIALIZED (SELECT g, {best} AS v{more} FROM (SELECT g, v, round(sum(w), 9) AS s, max(p) AS top, arg_max(id, p) AS id FROM c_{f} JOIN w{i}_{f} USING (p) GROUP BY g, v) GROUP BY g)")
        if i < rounds:
            out.append(f"w{i + 1}_{f} AS MATERIALIZED (SELECT p, -ln((count(*) FILTER (WHERE c.v <> x.v) + 1) / (count(*) + 2)) AS w FROM c_{f} c JOIN x{i}_{f} x USING (g) GROUP BY p)")
    return ", ".join(out)


_R = 8
ORACLES: dict[str, str] = {
    "p5_votes": f"WITH {_CLAIMS}, {_truth('valor')} SELECT grupo_id, filas, v AS valor, id AS registro_valor, round(parte, 6) AS apoyo_valor FROM s LEFT JOIN x{_R}_valor USING (g)",
    "p5_weights": f"WITH {_CLAIMS}, {_truth('valor')}, {_truth('planta_encontrada')}, {_truth('agente_encontrado')} " + " UNION ALL ".join(f"SELECT '{f}' AS campo, p AS fuente, round(w, 6) AS peso FROM w{_R}_{f}" for f in ("valor", "planta_encontrada", "agente_encontrado")),
    "p5_survivors": f"""WITH {_CLAIMS}, {_truth('planta_encontrada')}, {_truth('agente_encontrado')},
    o AS (SELECT g, first(valor ORDER BY (valor IS NOT NULL) DESC, p DESC, ingestion_timestamp DESC NULLS LAST, id DESC) AS valor, first(id ORDER BY (valor IS NOT NULL) DESC, p DESC, ingestion_timestamp DESC NULLS LAST, id DESC) AS registro_valor FROM k GROUP BY g)
    SELECT grupo_id, filas, valor, registro_valor, a.v AS planta_encontrada, a.id AS registro_planta_encontrada, round(a.parte, 6) AS apoyo_planta_encontrada, b.v AS agente_encontrado, b.id AS registro_agente_encontrado, round(b.parte, 6) AS apoyo_agente_encontrado
    FROM s JOIN o USING (g) LEFT JOIN x{_R}_planta_encontrada a USING (g) LEFT JOIN x{_R}_agente_encontrado b USING (g)""",
    "p5_found": """
    WITH r AS (SELECT registro_id, valor, ingestion_timestamp, upper(trim(version)) AS ver, dense_rank() OVER (ORDER BY upper(trim(codigo_variable)), fecha_hora,
        upper(trim(codigo_duracion)), upper(trim(unidad_medida)), upper(trim(codigo_agente)), upper(trim(codigo_planta))) AS g FROM generacion_real),
    k AS (SELECT *, CASE WHEN ver = 'TXF' THEN 4e15 WHEN ver = 'TXR' THEN 3e15 WHEN regexp_full_match(ver, 'TX[0-9]{1,15}') THEN substr(ver, 3)::BIGINT ELSE -1 END AS p FROM r)
    SELECT min(registro_id) AS grupo_id, first(registro_id ORDER BY (valor IS NOT NULL) DESC, p DESC, ingestion_timestamp DESC NULLS LAST, registro_id DESC) AS registro_id
    FROM k GROUP BY g HAVING count(*) >= 2""",
    "p7_same_letters": " UNION ALL ".join(
        f"""SELECT relacion_id, '{c}' AS campo, r.code AS codigo FROM plantas_reservorios p JOIN (SELECT {_letters(n)} AS k, min({code}) AS code FROM {ref} GROUP BY 1 HAVING count(*) = 1) r ON {_letters("p." + c)} = r.k
    WHERE trim(p.{c}) <> '' AND p.{c} NOT IN (SELECT {n} FROM {ref} WHERE {n} IS NOT NULL)"""
        for c, ref, code, n in TYPED
    ),
    "p8_counts": f"""
    WITH ig AS (SELECT DISTINCT array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT w, unnest(range(1, len(w) - 10)) AS k FROM (SELECT {_words("text")} AS w FROM eval_items) WHERE len(w) >= 12)),
    d AS (SELECT doc_id, {_words("text")} AS w FROM documents WHERE text IS NOT NULL),
    h AS (SELECT DISTINCT doc_id, k + unnest(range(0, 12)) AS pos FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM d WHERE len(w) >= 12) JOIN ig ON ig.g = array_to_string(w[k:k + 11], ' ')),
    n AS (SELECT doc_id, count(*) AS filtradas FROM h GROUP BY 1)
    SELECT doc_id, len(w) AS palabras, filtradas, filtradas > 0.5 * len(w) AS descartado FROM n JOIN d USING (doc_id)""",
    "p9_targets_met": "SELECT source, target_share AS objetivo, CAST(max_repeats AS INT) AS max_repeats, true AS cumple FROM mix_targets",
    "p10_plain_cases": r"""SELECT doc_id, CASE WHEN regexp_full_match(trim(text), '(?i)(https?://\S+\s*){6,}') THEN 'enlaces' ELSE 'etiquetas' END AS clase FROM documents
    WHERE regexp_full_match(trim(text), '(?i)(https?://\S+\s*){6,}') OR regexp_full_match(trim(text), '(#\w+[ ,]*){6,}')""",
    "p8_found": f"""
    WITH i AS (SELECT item_id, w, len(w) AS n FROM (SELECT item_id, {_words("text")} AS w FROM eval_items)),
    ig AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, n - 10)) AS k FROM i WHERE n >= 12)),
    d AS (SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, {_words("text")} AS w FROM documents)),
    dg AS (SELECT doc_id, array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, n - 10)) AS k FROM d WHERE n >= 12))
    SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)""",
}
