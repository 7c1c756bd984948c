"""Data-quality audit (D1–D7): completeness, freshness, uniqueness, consistency and accuracy, merged into one
scored diagnosis with alerts.

Execution shape (whatever the table size):

* one small job computes the moments of the numeric columns (mean, sample std) — used as a scalar subquery;
* one small job per key column counts its distinct values (map-side de-duplication, then a shuffle of the
  de-duplicated key values only — a key held by a third of all rows collapses to one row per map task);
* one scan + one global aggregate computes *everything else* at once: row count, per-column missing counts, stale
  rows, oldest date, rule violations and z-score outliers (partial aggregation, a one-row-per-task shuffle).

Everything downstream (dimension rows, diagnosis, alerts) is projected from that one-row result, so no dimension
re-scans the data.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpoint.functions.numeric import is_missing, safe_div

# Dimension names in report order, statuses, alert levels, severities, thresholds, score ladders
# (score when ok / warning / critico, and the largest total that is still a warning) and detail messages.
DIMENSIONS = ["completude", "frescor", "unicidade", "consistencia", "acuracia"]
OK, WARNING, CRITICO = "ok", "warning", "critico"
ALERT_CRITICAL, ALERT_WARNING = "CRITICO", "WARNING"
SEVERITY_HIGH, SEVERITY_MEDIUM, SEVERITY_LOW, SEVERITY_NONE = "ALTA", "MÉDIA", "BAIXA", "OK"
MAX_SCORE_PER_DIMENSION = 20
NULL_PCT_LIMIT = 5.0
Z_LIMIT = 3.0
COMPLETUDE_PENALTY_PER_COLUMN, COMPLETUDE_WARNING_MAX = 5, 2
FRESCOR_OK_PCT, FRESCOR_WARNING_PCT = 5, 15
FRESCOR_SCORES = (20, 15, 10)
UNICIDADE_SCORES, UNICIDADE_WARNING_MAX = (20, 15, 5), 2
CONSISTENCIA_SCORES, CONSISTENCIA_WARNING_MAX = (20, 12, 5), 5
ACURACIA_SCORES, ACURACIA_WARNING_MAX = (20, 12, 5), 5
MSG_COMPLETUDE, MSG_COMPLETUDE_OK = "%d colunas com >5%% nulos", "Todas as colunas OK"
MSG_FRESCOR = "%% dos registros sem atualização há >%d anos"
MSG_UNICIDADE, MSG_UNICIDADE_OK = "%d duplicatas encontradas", "Sem duplicatas"
MSG_CONSISTENCIA, MSG_CONSISTENCIA_OK = "%d violações em %d regras", "Todas as regras OK"
MSG_ACURACIA, MSG_ACURACIA_OK = "%d outliers em %d colunas", "Sem outliers"
DEFAULT_DATE_COLUMN = "data_atualizacao"
DEFAULT_STALE_DAYS = 730
DEFAULT_KEY_COLUMNS = ("cpf",)
DEFAULT_NUMERIC_COLUMNS = ("renda", "compras_12m")

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


@dataclass(frozen=True)
class Rule:
    """A consistency rule: ``violation`` is true for a violating row; NULL inputs do not violate."""
    name: str
    violation: Column
    requires: tuple[str, ...]


def default_rules() -> list[Rule]:
    # The three business rules and their names.
    return [
        Rule("idade >= 0", F.col("idade") < 0, ("idade",)),
        Rule("email contém @", F.col("email").isNotNull() & ~F.col("email").contains("@"), ("email",)),
        Rule("data_nascimento <= data_cadastro", F.col("data_nascimento") > F.col("data_cadastro"),
             ("data_nascimento", "data_cadastro")),
    ]


def round_even(c: Column, places: int = 2) -> Column:
    """Half-to-even rounding of the scaled double (numpy/pandas ``round`` as used by the audit)."""
    scale = float(10 ** places)
    return F.bround(c.cast("double") * F.lit(scale), 0) / F.lit(scale)


@dataclass
class AuditConfig:
    ref_date: dt.date
    date_column: str = DEFAULT_DATE_COLUMN
    stale_days: int = DEFAULT_STALE_DAYS
    key_columns: tuple[str, ...] = DEFAULT_KEY_COLUMNS
    numeric_columns: tuple[str, ...] = DEFAULT_NUMERIC_COLUMNS
    rules: list[Rule] = field(default_factory=default_rules)
    profile_max: str = "renda"
    profile_mean: str = "compras_12m"


def _status3(total: Column, warn_max: int, scores: tuple[int, int, int]) -> tuple[Column, Column]:
    """ok when the total is 0, warning up to ``warn_max``, critico above; scores from the ladder."""
    status = F.when(total == 0, F.lit(OK)).when(total <= warn_max, F.lit(WARNING)).otherwise(F.lit(CRITICO))
    score = (F.when(total == 0, F.lit(scores[0])).when(total <= warn_max, F.lit(scores[1]))
             .otherwise(F.lit(scores[2])))
    return status, score.cast("bigint")


class Audit:
    """All five audits of one frame. Attributes are lazy DataFrames derived from one aggregate."""

    def __init__(self, df: DataFrame, config: AuditConfig):
        self.df = df
        self.cfg = config
        if config.date_column not in df.columns:
            raise KeyError(f"coluna de data ausente: {config.date_column}")
        types = {f.name: f.dataType for f in df.schema.fields}
        self.columns = list(df.columns)
        self.keys = [k for k in config.key_columns if k in types]
        self.rules = [r for r in config.rules if all(c in types for c in r.requires)]
        self.numeric = [c for c in config.numeric_columns if c in types and isinstance(types[c], NUMERIC_TYPES)]
        self._types = types
        self.stats = self._aggregate()

    # ---- the two passes -------------------------------------------------------------------------------------
    def _moments(self) -> Column | None:
        if not self.numeric:
            return None
        fields = []
        for c in self.numeric:
            x = self._valid(c)
            fields += [F.avg(x).alias(f"m_{c}"), F.stddev_samp(x).alias(f"s_{c}")]
        return self.df.agg(F.struct(*fields).alias("st")).select("st").scalar()

    def _valid(self, c: str) -> Column:
        """Numeric value with NULL/NaN removed (pandas ``dropna``)."""
        return F.when(~is_missing(c, self._types[c]), F.col(c).cast("double"))

    def _aggregate(self) -> DataFrame:
        df = self.df
        moments = self._moments()
        if moments is not None:
            df = df.withColumn("__moments", moments)  # one subquery, referenced by field below
        limit = F.date_sub(F.lit(self.cfg.ref_date), self.cfg.stale_days)
        d = F.col(self.cfg.date_column)
        exprs = [F.count(F.lit(1)).alias("n"),
                 F.count_if(d < limit).alias("stale"),
                 F.min(d).cast("date").alias("oldest")]
        for c in self.columns:
            exprs.append(F.count_if(is_missing(c, self._types[c])).alias(f"null__{c}"))
        for k in self.keys:
            exprs.append(F.count_if(F.col(k).isNull()).alias(f"sqlnull__{k}"))
        for i, r in enumerate(self.rules):
            exprs.append(F.count_if(F.coalesce(r.violation, F.lit(False))).alias(f"rule__{i}"))
        # R3 profile extras ride along in the same aggregate
        exprs.append(F.count_if(F.col("email").contains("@")).alias("p_email") if "email" in self._types
                     else F.lit(None).cast("bigint").alias("p_email"))
        exprs.append(F.max(self._valid(self.cfg.profile_max)).alias("p_max") if self.cfg.profile_max in self._types
                     else F.lit(None).cast("double").alias("p_max"))
        exprs.append(F.avg(self._valid(self.cfg.profile_mean)).alias("p_mean") if self.cfg.profile_mean in self._types
                     else F.lit(None).cast("double").alias("p_mean"))
        for c in self.numeric:
            x = self._valid(c)
            z = F.abs(safe_div(x - F.col(f"__moments.m_{c}"), F.col(f"__moments.s_{c}")))
            exprs += [F.count(x).alias(f"valid__{c}"), F.count_if(z > F.lit(Z_LIMIT)).alias(f"out__{c}")]
        # Distinct keys come from one small aggregate per key column (a scalar subquery): it shuffles only that
        # column's de-duplicated values. Inside the main aggregate a distinct count would make Spark group *all*
        # buffers by the key — with near-unique keys, a shuffle of every row's partial state.
        distincts = [self.df.agg(F.count_distinct(k).alias("d")).select("d").scalar().alias(f"distinct__{k}")
                     for k in self.keys]
        return df.agg(*exprs).select("*", *distincts)

    def freeze(self) -> "Audit":
        """Run the two passes now and keep their one-row result as a local relation.

        Every later projection (dimensions, diagnosis, alerts) then works on that single bounded row without
        re-running or re-compiling the aggregate — used by the audit job, which needs several views of one result.
        """
        row = self.stats.first()
        self.stats = self.df.sparkSession.createDataFrame([row], self.stats.schema)
        return self

    # ---- per-dimension long tables ----------------------------------------------------------------------------
    def completude_table(self) -> DataFrame:
        """D1 per column: (coluna, nulos, pct_nulos [2 dp], critica = pct_nulos > 5)."""
        rows = [F.struct(F.lit(c).alias("coluna"), F.col(f"null__{c}").cast("bigint").alias("nulos"),
                         round_even(safe_div(F.col(f"null__{c}"), F.col("n")) * F.lit(100.0)).alias("pct_nulos"))
                for c in self.columns]
        t = self.stats.select(F.inline(F.array(*rows)))
        return t.withColumn("critica", F.coalesce(F.col("pct_nulos") > F.lit(NULL_PCT_LIMIT), F.lit(False)))

    def unicidade_table(self) -> DataFrame:
        """D3 per key column: duplicates = extra occurrences after the first, NULLs counted as equal."""
        rows = [F.struct(F.lit(k).alias("coluna"),
                         (F.col("n") - F.col(f"distinct__{k}")
                          - F.when(F.col(f"sqlnull__{k}") > 0, 1).otherwise(0)).cast("bigint").alias("duplicatas"))
                for k in self.keys]
        if not rows:
            return self.stats.select(F.lit(None).cast("string").alias("coluna"),
                                     F.lit(None).cast("bigint").alias("duplicatas")).limit(0)
        return self.stats.select(F.inline(F.array(*rows)))

    def consistencia_table(self) -> DataFrame:
        """D4 per rule: (regra, violacoes)."""
        rows = [F.struct(F.lit(r.name).alias("regra"), F.col(f"rule__{i}").cast("bigint").alias("violacoes"))
                for i, r in enumerate(self.rules)]
        if not rows:
            return self.stats.select(F.lit(None).cast("string").alias("regra"),
                                     F.lit(None).cast("bigint").alias("violacoes")).limit(0)
        return self.stats.select(F.inline(F.array(*rows)))

    def acuracia_table(self) -> DataFrame:
        """D5 per numeric column: (coluna, validos, outliers, pct [2 dp of the non-null rows])."""
        rows = [F.struct(F.lit(c).alias("coluna"), F.col(f"valid__{c}").cast("bigint").alias("validos"),
                         F.col(f"out__{c}").cast("bigint").alias("outliers"),
                         round_even(safe_div(F.col(f"out__{c}"), F.col(f"valid__{c}")) * F.lit(100.0)).alias("pct"))
                for c in self.numeric]
        if not rows:
            return self.stats.select(F.lit(None).cast("string").alias("coluna"), F.lit(None).cast("bigint").alias(
                "validos"), F.lit(None).cast("bigint").alias("outliers"), F.lit(None).cast("double").alias("pct")
            ).limit(0)
        return self.stats.select(F.inline(F.array(*rows)))

    # ---- dimension summaries --------------------------------------------------------------------------------
    def _scalars(self) -> DataFrame:
        """One row: the aggregate plus each dimension's derived scalar, each computed once."""
        n = F.col("n")
        pct_cols = [round_even(safe_div(F.col(f"null__{c}"), n) * F.lit(100.0)) for c in self.columns]
        k1 = sum((F.coalesce(p > F.lit(NULL_PCT_LIMIT), F.lit(False)).cast("int") for p in pct_cols), F.lit(0))
        pct2 = round_even(safe_div(F.col("stale"), n) * F.lit(100.0))
        dups = sum(((n - F.col(f"distinct__{kc}") - F.when(F.col(f"sqlnull__{kc}") > 0, 1).otherwise(0))
                    for kc in self.keys), F.lit(0))
        viol = [F.col(f"rule__{i}") for i in range(len(self.rules))]
        outs = [F.col(f"out__{c}") for c in self.numeric]
        return self.stats.select(
            "*", k1.cast("bigint").alias("_k1"), pct2.alias("_pct2"), dups.cast("bigint").alias("_dups"),
            sum(viol, F.lit(0)).cast("bigint").alias("_tot4"),
            sum(((v > 0).cast("int") for v in viol), F.lit(0)).alias("_nrules"),
            sum(outs, F.lit(0)).cast("bigint").alias("_tot5"),
            sum(((o > 0).cast("int") for o in outs), F.lit(0)).alias("_ncols"))

    def _dimension_structs(self) -> list[Column]:
        """The five dimension structs, as expressions over :meth:`_scalars`."""
        k, pct = F.col("_k1"), F.col("_pct2")
        d1 = (F.when(k == 0, F.lit(OK)).when(k <= COMPLETUDE_WARNING_MAX, F.lit(WARNING)).otherwise(F.lit(CRITICO)),
              F.greatest(F.lit(0), F.lit(MAX_SCORE_PER_DIMENSION) - k * COMPLETUDE_PENALTY_PER_COLUMN).cast("bigint"),
              F.when(k > 0, F.format_string(MSG_COMPLETUDE, k)).otherwise(F.lit(MSG_COMPLETUDE_OK)),
              k)
        # D2 freshness: NULL dates are not stale but stay in the denominator; empty input → NULL pct → critico
        d2 = (F.when(pct <= FRESCOR_OK_PCT, F.lit(OK)).when(pct <= FRESCOR_WARNING_PCT, F.lit(WARNING))
              .otherwise(F.lit(CRITICO)),
              F.when(pct <= FRESCOR_OK_PCT, F.lit(FRESCOR_SCORES[0])).when(pct <= FRESCOR_WARNING_PCT,
                                                                          F.lit(FRESCOR_SCORES[1]))
              .otherwise(F.lit(FRESCOR_SCORES[2])).cast("bigint"),
              F.concat(F.coalesce(pct.cast("string"), F.lit("nan")),
                       F.lit(MSG_FRESCOR % (self.cfg.stale_days // 365))),
              F.col("stale").cast("bigint"))
        dups = F.col("_dups")
        s3, sc3 = _status3(dups, UNICIDADE_WARNING_MAX, UNICIDADE_SCORES)
        d3 = (s3, sc3, F.when(dups > 0, F.format_string(MSG_UNICIDADE, dups)).otherwise(F.lit(MSG_UNICIDADE_OK)), dups)
        tot4 = F.col("_tot4")
        s4, sc4 = _status3(tot4, CONSISTENCIA_WARNING_MAX, CONSISTENCIA_SCORES)
        d4 = (s4, sc4, F.when(tot4 > 0, F.format_string(MSG_CONSISTENCIA, tot4, F.col("_nrules")))
              .otherwise(F.lit(MSG_CONSISTENCIA_OK)), tot4)
        tot5 = F.col("_tot5")
        s5, sc5 = _status3(tot5, ACURACIA_WARNING_MAX, ACURACIA_SCORES)
        d5 = (s5, sc5, F.when(tot5 > 0, F.format_string(MSG_ACURACIA, tot5, F.col("_ncols")))
              .otherwise(F.lit(MSG_ACURACIA_OK)), tot5)
        out = []
        for i, (name, (st, sc, det, total)) in enumerate(zip(DIMENSIONS, [d1, d2, d3, d4, d5])):
            out.append(F.struct(F.lit(i + 1).cast("bigint").alias("ordem"), F.lit(name).alias("dimensao"),
                                st.alias("status"), sc.alias("score"), det.alias("detalhes"),
                                total.alias("ocorrencias")))
        return out

    def _dims_frame(self) -> DataFrame:
        """One row: the five dimension structs as columns ``d1`` … ``d5`` (computed once, referenced by name)."""
        return self._scalars().select("n", *[d.alias(f"d{i + 1}") for i, d in enumerate(self._dimension_structs())])

    def dimensoes(self) -> DataFrame:
        """The five dimension results: (ordem, dimensao, status, score, detalhes, ocorrencias)."""
        return self._dims_frame().select(F.inline(F.array(*[F.col(f"d{i + 1}") for i in range(len(DIMENSIONS))])))

    def frescor(self) -> DataFrame:
        """D2 detail: stale rows, stale % (2 dp), oldest date."""
        pct = round_even(safe_div(F.col("stale"), F.col("n")) * F.lit(100.0))
        return self.stats.select(F.col("stale").cast("bigint").alias("registros_desatualizados"),
                                 pct.alias("pct_desatualizado"), F.col("oldest").alias("data_mais_antiga"))

    def _diagnosis_columns(self) -> list[Column]:
        """Total score, severity, counts per status and the ordered alert list (criticos first, then warnings,
        each in dimension order). Built from the five dimension structs with plain column expressions."""
        dims = [F.col(f"d{i + 1}") for i in range(len(DIMENSIONS))]
        status = [d.getField("status") for d in dims]

        def count(st):
            return sum(((s_ == st).cast("int") for s_ in status), F.lit(0))

        def alerts(st, level):
            return F.array_compact(F.array(*[
                F.when(d.getField("status") == st,
                       F.struct(F.lit(level).alias("nivel"), d.getField("dimensao").alias("dimensao"),
                                d.getField("detalhes").alias("mensagem"))) for d in dims]))
        n_crit, n_warn = count(CRITICO), count(WARNING)
        severity = (F.when(n_crit >= 2, F.lit(SEVERITY_HIGH))
                    .when((n_crit >= 1) | (n_warn >= 3), F.lit(SEVERITY_MEDIUM))
                    .when(n_warn >= 1, F.lit(SEVERITY_LOW)).otherwise(F.lit(SEVERITY_NONE)))
        total = sum((d.getField("score") for d in dims), F.lit(0))
        return [
            total.cast("bigint").alias("score_qualidade"),
            F.lit(MAX_SCORE_PER_DIMENSION * len(DIMENSIONS)).cast("bigint").alias("score_maximo"),
            severity.alias("severidade"),
            count(OK).cast("bigint").alias("dimensoes_ok"),
            n_warn.cast("bigint").alias("dimensoes_warning"),
            n_crit.cast("bigint").alias("dimensoes_criticas"),
            F.concat(alerts(CRITICO, ALERT_CRITICAL), alerts(WARNING, ALERT_WARNING)).alias("alertas")]

    def diagnostico(self) -> DataFrame:
        """D6 as a one-row frame."""
        return self._dims_frame().select(*self._diagnosis_columns())

    def report(self) -> DataFrame:
        """Everything in one row (one action): diagnosis, the five dimension structs and the row count."""
        dims = F.array(*[F.col(f"d{i + 1}") for i in range(len(DIMENSIONS))])
        return self._dims_frame().select(*self._diagnosis_columns(), dims.alias("dimensoes"),
                                         F.col("n").cast("bigint").alias("linhas"))

    def alertas(self) -> DataFrame:
        """D6 alerts as rows: (ordem, nivel, dimensao, mensagem)."""
        return self.diagnostico().select(F.posexplode("alertas").alias("pos", "a")).select(
            (F.col("pos") + 1).cast("bigint").alias("ordem"), "a.nivel", "a.dimensao", "a.mensagem")

    def profile(self) -> DataFrame:
        """Customer profile projected from the same single aggregate — rows, null cells, stale rows, duplicate
        keys, valid e-mails, max of ``profile_max`` and mean (2 dp) of ``profile_mean``."""
        cells = sum((F.col(f"null__{c}") for c in self.columns), F.lit(0)).cast("bigint")
        return self._scalars().select(
            F.col("n").cast("bigint").alias("linhas"), cells.alias("celulas_nulas"),
            F.col("stale").cast("bigint").alias("desatualizados"), F.col("_dups").alias("duplicatas"),
            F.col("p_email").cast("bigint").alias("emails_validos"),
            F.col("p_max").cast("double").alias(f"{self.cfg.profile_max}_max"),
            round_even(F.col("p_mean"), 2).alias(f"{self.cfg.profile_mean}_medio"))

    def overall_null_pct(self) -> DataFrame:
        """Null cells / (rows × columns) × 100, and the raw counts (``no_load`` summary, A3)."""
        cells = sum((F.col(f"null__{c}") for c in self.columns), F.lit(0)).cast("bigint")
        return self.stats.select(F.col("n").cast("bigint").alias("linhas"),
                                 F.lit(len(self.columns)).cast("bigint").alias("colunas"),
                                 cells.alias("celulas_nulas"),
                                 safe_div(cells, F.col("n") * F.lit(len(self.columns))).alias("_f"))\
            .withColumn("pct_celulas_nulas", F.col("_f") * F.lit(100.0)).drop("_f")


def audit(df: DataFrame, ref_date: dt.date, **kw) -> Audit:
    return Audit(df, AuditConfig(ref_date=ref_date, **kw))
