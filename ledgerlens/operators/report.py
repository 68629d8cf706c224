"""Summary and report operators.

The executive summary is one scan of the scored table, distinct customers as
exact bitmaps (or is read off the analysis cube); the
Markdown report is a DataFrame of lines ``(section_no, section, line_no,
line)`` and the plain-text report one of ``(line_no, line)``, both built from
the small aggregated results with Spark's own formatting functions and
written as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Thresholds, scratch_path
from ..functions import exprs as X
from ..functions import labels as L
from .analytics import _measures, with_unique_customers

# Report headings, labels and JSON keys (display text).
TITLE = "# REPORTE DE ANÁLISIS BANCARIO"
GENERATED = "Fecha de generación: "
PERIOD = "Período analizado: "
H_SUMMARY = "## RESUMEN EJECUTIVO"
M_TOTAL = "- Total de transacciones procesadas: "
M_CUSTOMERS = "- Clientes únicos: "
M_AMOUNT = "- Monto total procesado: €"
M_AVG = "- Monto promedio por transacción: €"
H_STATUS = "## Distribución de Estados"
T_STATUS = ("| Estado | Cantidad | Porcentaje |", "|--------|----------|------------|")
STATUS_LABELS = (
    (L.STATUS_APPROVED, "Aprobadas"),
    (L.STATUS_DECLINED, "Rechazadas"),
    (L.STATUS_FRAUD, "Fraude"),
    (L.STATUS_PENDING, "Pendientes"),
)
H_ALERTS = "## Alertas de Fraude"
M_ALERTS = "- Total de alertas detectadas: "
M_DETECTION = "- Tasa de detección: "
H_COUNTRY = "## ANÁLISIS POR PAÍS"
T_COUNTRY = ("| País | Transacciones | Monto Total | Monto Promedio | Tasa Aprobación |",
             "|------|---------------|-------------|----------------|------------------|")
H_CATEGORY = "## ANÁLISIS POR CATEGORÍA"
T_CATEGORY = ("| Categoría | Transacciones | Monto Total | Porcentaje |",
              "|-----------|---------------|-------------|------------|")
H_TIME = "## ANÁLISIS TEMPORAL"
T_TIME = ("| Franja Horaria | Transacciones | Monto Total | Rechazadas |",
          "|----------------|---------------|-------------|------------|")
H_CONCLUSIONS = "## CONCLUSIONES"
C_PROCESSED = ("1. Se procesaron ", " transacciones")
C_APPROVAL = "2. Tasa de aprobación: "
C_ALERTS = ("3. Se detectaron ", " alertas de posible fraude")
JSON_GROUPS = {
    "metricas_generales": (("total_transacciones", "total_transactions"),
                           ("clientes_unicos", "unique_customers"),
                           ("monto_total", "total_amount"),
                           ("monto_promedio", "avg_amount")),
    "distribucion_estados": (("aprobadas", "approved"), ("rechazadas", "declined"),
                             ("fraude", "fraud"), ("pendientes", "pending"),
                             ("tasa_aprobacion", "approval_rate")),
    "alertas_fraude": (("total_alertas", "total_alerts"),
                       ("tasa_deteccion", "detection_rate")),
}

SECTIONS = ("resumen", "estados", "alertas", "pais", "categoria", "temporal", "conclusiones")

# Plain-text report layout (display text).
TXT_RULE = "=" * 80
TXT_TITLE = "REPORTE DE ANÁLISIS BANCARIO"
TXT_GENERATED = "Fecha de generación: "
TXT_PERIOD = "Período analizado: "
TXT_SUMMARY = "RESUMEN EJECUTIVO"
TXT_METRICS = "MÉTRICAS GENERALES:"
TXT_TOTAL = "  - Total transacciones procesadas: "
TXT_CUSTOMERS = "  - Clientes únicos: "
TXT_AMOUNT = "  - Monto total procesado: "
TXT_AVG = "  - Monto promedio: "
TXT_STATUS = "DISTRIBUCIÓN DE ESTADOS:"
TXT_APPROVED = "  - Aprobadas: "
TXT_DECLINED = "  - Rechazadas: "
TXT_FRAUD = "  - Fraude: "
TXT_PENDING = "  - Pendientes: "
TXT_ALERTS = "ALERTAS DE FRAUDE:"
TXT_ALERT_TOTAL = "  - Total alertas detectadas: "
TXT_DETECTION = "  - Tasa de detección: "
TXT_DONE = "PIPELINE EJECUTADO EXITOSAMENTE"
TXT_STAGES = "Fases completadas:"
STAGE_LABELS = (
    ("ingest", "Ingesta y validación"),
    ("transform", "Transformación y enriquecimiento"),
    ("fraud", "Detección de anomalías"),
    ("tables", "Creación de tablas"),
    ("analyses", "Queries analíticas"),
    ("reports", "Generación de reportes"),
)


def executive_summary(scored: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Every headline figure, distinct customers included, in one scan
    (the reference ran nine jobs). ``total_alerts`` counts rows flagged by the
    rules."""
    own = with_unique_customers(scored, [], _measures(
        "n", "amount_sum", "amount_rest", "amount_n", "approved", "declined", "fraud", "pending", "alerts", "ts_min", "ts_max", t=t))
    return _summary(own.withColumns({c: F.coalesce(c, F.lit(0)) for c in (
        "n", "approved", "declined", "fraud", "pending", "alerts")}))


def _summary(wide: DataFrame) -> DataFrame:
    """The summary's columns from the measures of the whole table."""
    amount = X.joined(F.col("amount_sum"), F.col("amount_rest"))
    return wide.select(
        F.col("n").alias("total_transactions"),
        "unique_customers",
        X.round2(amount).alias("total_amount"),
        X.round2(amount / F.col("amount_n").cast("double")).alias("avg_amount"),
        "approved", "declined", "fraud", "pending",
        X.pct(F.col("approved"), F.col("n")).alias("approval_rate"),
        F.col("alerts").alias("total_alerts"),
        X.pct(F.col("alerts"), F.col("n")).alias("detection_rate"),
        F.date_format("ts_min", "yyyy-MM-dd").alias("period_start"),
        F.date_format("ts_max", "yyyy-MM-dd").alias("period_end"),
    )


def executive_summary_from_cube(cube: DataFrame) -> DataFrame:
    """R1 read off the analysis cube (its ``all`` and ``customer`` sets)
    instead of another scan of the table; equal to ``executive_summary``."""
    rows = cube.filter(F.col("grouping_set").isin("all", "customer"))
    one = lambda m: F.max(F.when(F.col("grouping_set") == "all", F.col(m)))
    counts = ("n", "approved", "declined", "fraud", "pending", "alerts")
    wide = rows.agg(
        *[F.coalesce(one(m), F.lit(0)).alias(m) for m in counts],
        *[one(m).alias(m) for m in ("amount_sum", "amount_rest", "amount_n", "ts_min", "ts_max")],
        X.count_if((F.col("grouping_set") == "customer") & F.col("customer_id").isNotNull())
        .alias("unique_customers"),
    )
    return _summary(wide)


_STATUS_COLS = {L.STATUS_APPROVED: "approved", L.STATUS_DECLINED: "declined",
                L.STATUS_FRAUD: "fraud", L.STATUS_PENDING: "pending"}


def status_distribution(summary: DataFrame) -> DataFrame:
    """R2: the four statuses in fixed order with count and share; a status
    with no rows shows 0. Derived from the one-row summary (no join)."""
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(s).alias("status"),
                 F.lit(label).alias("label"), F.col(_STATUS_COLS[s]).alias("count"))
        for i, (s, label) in enumerate(STATUS_LABELS, start=1)
    ]
    long = summary.select(F.explode(F.array(*rows)).alias("r"), "total_transactions")
    return long.select(
        "r.position", "r.status", "r.label", "r.count",
        X.pct(F.col("r.count"), F.col("total_transactions")).alias("percentage"),
    )


def report_country(by_country: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` countries by total amount."""
    return by_country.orderBy(F.col("total_amount").desc_nulls_last(),
                              F.col("country").asc_nulls_last()).limit(n)


def report_category(by_category: DataFrame) -> DataFrame:
    """R4."""
    return by_category.select("category", "total_transactions", "total_amount", "percentage")


def report_time(by_time_slot: DataFrame) -> DataFrame:
    """R5."""
    return by_time_slot.select("time_slot", "total_transactions", "total_amount",
                               "declined_count")


def _int(c: str | Column) -> Column:
    return F.format_number(X.col(c), 0)


def _dec(c: str | Column) -> Column:
    return F.format_number(X.col(c), 2)


def _plain(c: str | Column) -> Column:
    """A number without thousands separators, as it is written."""
    return X.col(c).cast("string")


def _cents(c: str | Column) -> Column:
    return F.format_string("%.2f", X.col(c))


def numbered(rows: DataFrame, order: list[Column], name: str = "numbered") -> DataFrame:
    """``rows`` with ``row_no`` (from 1) in ``order``, without a task that
    holds all of them: the rows are sorted by range partitions and written,
    and a row's number is its place in its file plus the rows of the files
    before it. Only one row per file is added up in one task."""
    path = scratch_path(rows.sparkSession, name)
    rows.orderBy(*order).write.parquet(path)
    back = rows.sparkSession.read.schema(rows.schema).parquet(path)
    placed = back.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    files = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select(F.col("_file").alias("_of"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    # one row a file
    return placed.join(F.broadcast(offsets), F.col("_file") == F.col("_of")).select(
        *[F.col(f"`{c}`") for c in rows.columns], (F.col("_before") + F.col("_place") + 1).alias("row_no"))


def _table(section: int, header: tuple[str, str], rows: DataFrame,
           order: list[Column], line: Column, spark, bounded: bool = True) -> DataFrame:
    """Table header and one line per row of a result. ``bounded``: its rows
    are a top-k or a fixed list, so one window may number them."""
    head = spark.createDataFrame(
        [(section, SECTIONS[section - 1], i, s) for i, s in enumerate(header, start=1)],
        "section_no int, section string, line_no int, line string")
    if bounded:
        rows = rows.withColumn("row_no", F.row_number().over(Window.orderBy(*order)))
    else:
        rows = numbered(rows, order)
    body = rows.select(
        F.lit(section).alias("section_no"), F.lit(SECTIONS[section - 1]).alias("section"),
        (F.col("row_no") + 2).cast("int").alias("line_no"), line.alias("line"))
    return head.unionByName(body)


def _cells(*cells: Column) -> Column:
    parts = [F.lit("| ")]
    for c in cells:
        parts += [c, F.lit(" | ")]
    return F.concat(*parts[:-1], F.lit(" |"))


def report_lines(summary: DataFrame, by_country: DataFrame | None = None,
                 by_category: DataFrame | None = None,
                 by_time_slot: DataFrame | None = None,
                 generated_at: Column | None = None) -> DataFrame:
    """R6/R7 (+R9): the report as ordered lines. A section whose analysis is
    absent (None) keeps its heading and has no table. All lines of the summary
    come from one pass over its one row; the generation time is an input."""
    spark = summary.sparkSession
    money, rate = (lambda c: F.concat(F.lit("€"), _dec(c))), (lambda c: F.concat(_plain(c), F.lit("%")))
    first = [
        F.lit(TITLE),
        *([] if generated_at is None else [F.concat(F.lit(GENERATED), generated_at)]),
        F.concat(F.lit(PERIOD), F.col("period_start"), F.lit(" a "), F.col("period_end")),
        F.lit(H_SUMMARY),
        F.concat(F.lit(M_TOTAL), _int("total_transactions")),
        F.concat(F.lit(M_CUSTOMERS), _int("unique_customers")),
        F.concat(F.lit(M_AMOUNT), _dec("total_amount")),
        F.concat(F.lit(M_AVG), _cents("avg_amount")),
    ]
    total = F.col("total_transactions")
    shares = [_cells(F.lit(label), _int(_STATUS_COLS[st]), rate(X.pct(F.col(_STATUS_COLS[st]), total)))
              for st, label in STATUS_LABELS]
    sections = {
        1: first,
        2: [F.lit(H_STATUS), *map(F.lit, T_STATUS), *shares],
        3: [F.lit(H_ALERTS), F.concat(F.lit(M_ALERTS), _plain("total_alerts")),
            F.concat(F.lit(M_DETECTION), rate("detection_rate"))],
        4: [F.lit(H_COUNTRY)], 5: [F.lit(H_CATEGORY)], 6: [F.lit(H_TIME)],
        7: [F.lit(H_CONCLUSIONS),
            F.concat(F.lit(C_PROCESSED[0]), _int("total_transactions"), F.lit(C_PROCESSED[1])),
            F.concat(F.lit(C_APPROVAL), rate("approval_rate")),
            F.concat(F.lit(C_ALERTS[0]), _plain("total_alerts"), F.lit(C_ALERTS[1]))],
    }
    rows = [F.struct(F.lit(n).alias("section_no"), F.lit(SECTIONS[n - 1]).alias("section"),
                     F.lit(i).alias("line_no"), line.alias("line"))
            for n, lines in sections.items() for i, line in enumerate(lines)]
    out = summary.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if by_country is not None:
        out = out.unionByName(_table(
            4, T_COUNTRY, report_country(by_country),
            [F.col("total_amount").desc_nulls_last(), F.col("country")],
            _cells(F.col("country"), _int("total_transactions"), money("total_amount"),
                   F.concat(F.lit("€"), _cents("avg_amount")), rate("approval_rate")), spark))
    if by_category is not None:
        out = out.unionByName(_table(
            5, T_CATEGORY, report_category(by_category),
            [F.col("total_transactions").desc(), F.col("category")],
            _cells(F.col("category"), _int("total_transactions"), money("total_amount"), rate("percentage")), spark,
            bounded=False))
    if by_time_slot is not None:
        out = out.unionByName(_table(
            6, T_TIME, report_time(by_time_slot),
            [X.slot_rank("time_slot").asc_nulls_last(), F.col("time_slot")],
            _cells(F.col("time_slot"), _int("total_transactions"), money("total_amount"),
                   _plain("declined_count")), spark))
    return out


def text_report_lines(summary: DataFrame, generated_at: str | Column | None = None,
                      stages: list[str] | None = None) -> DataFrame:
    """The plain-text summary as ordered lines ``(line_no, line)``,
    formatted by Spark from the one-row summary. The generation time and the
    completed stages are inputs (left out when None), so the same summary
    always gives the same lines."""
    s = F.col
    rule, blank = F.lit(TXT_RULE), F.lit("")
    lines: list[Column] = [rule, F.lit(TXT_TITLE), rule, blank]
    if generated_at is not None:
        lines.append(F.concat(F.lit(TXT_GENERATED), X.col(generated_at)
                              if not isinstance(generated_at, str) else F.lit(generated_at)))
    lines += [
        F.concat(F.lit(TXT_PERIOD), s("period_start"), F.lit(" a "), s("period_end")),
        blank, rule, F.lit(TXT_SUMMARY), rule, blank,
        F.lit(TXT_METRICS),
        F.concat(F.lit(TXT_TOTAL), _int("total_transactions")),
        F.concat(F.lit(TXT_CUSTOMERS), _int("unique_customers")),
        F.concat(F.lit(TXT_AMOUNT), _dec("total_amount")),
        F.concat(F.lit(TXT_AVG), F.format_string("%.2f", s("avg_amount"))),
        blank,
        F.lit(TXT_STATUS),
        F.concat(F.lit(TXT_APPROVED), _int("approved"), F.lit(" ("),
                 s("approval_rate").cast("string"), F.lit("%)")),
        F.concat(F.lit(TXT_DECLINED), _int("declined")),
        F.concat(F.lit(TXT_FRAUD), _int("fraud")),
        F.concat(F.lit(TXT_PENDING), _int("pending")),
        blank,
        F.lit(TXT_ALERTS),
        F.concat(F.lit(TXT_ALERT_TOTAL), s("total_alerts").cast("string")),
        F.concat(F.lit(TXT_DETECTION), s("detection_rate").cast("string"), F.lit("%")),
        blank,
    ]
    if stages is not None:
        labels = dict(STAGE_LABELS)
        lines += [rule, F.lit(TXT_DONE), rule, blank, F.lit(TXT_STAGES)]
        lines += [F.lit(f"  ✅ Fase {i}: {labels.get(name, name)}")
                  for i, name in enumerate(stages, start=1)]
        lines += [blank]
    lines.append(rule)
    rows = [F.struct(F.lit(i).alias("line_no"), line.alias("line"))
            for i, line in enumerate(lines)]
    return summary.select(F.explode(F.array(*rows)).alias("r")).select("r.line_no", "r.line")


def write_text_report(lines: DataFrame, path: str) -> None:
    """The plain-text report as one file (a few dozen lines: one task)."""
    lines.orderBy("line_no").select("line").coalesce(1).write.mode("overwrite").text(path)


def summary_json(summary: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """The summary as three nested groups plus the period and the
    generation time (now, unless given)."""
    groups = [
        F.struct(*[F.col(src).alias(key) for key, src in fields]).alias(name)
        for name, fields in JSON_GROUPS.items()
    ]
    period = F.concat(F.col("period_start"), F.lit(" a "), F.col("period_end"))
    generated = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if generated_at is None else generated_at
    return summary.select(generated.alias("fecha_generacion"),
                          period.alias("periodo_analizado"), *groups)


def write_report(lines: DataFrame, path: str) -> None:
    """The report as text, sorted by range partitions: a few dozen lines
    come out as one file, a table of very many categories as several in
    order."""
    lines.orderBy("section_no", "line_no").select("line").write.mode("overwrite").text(path)


def write_summary_json(summary: DataFrame, path: str, generated_at: Column | None = None) -> None:
    summary_json(summary, generated_at).coalesce(1).write.mode("overwrite").json(path)
