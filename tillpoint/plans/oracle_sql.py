"""DuckDB SQL for the registered queries, compared value by value with the Spark plans.

Origin: the semantics come from the survey of the reference. Earlier versions of the F1–F8 queries followed the
reference's own queries closely; they are now stated in other forms: pre-aggregated keys for F1 and F2, a window over
one aggregate for F3 and F7, a join on the month's position for F4, a range of row positions for F6, and a count of
better products for F8. Money is summed as DECIMAL, divisors pass through NULLIF, roundings are ``ROUND(double, n)``.
"""

from __future__ import annotations

from tillpoint.operators.features import WEEKDAY_NAMES

REF_DATE_SQL = "DATE '2001-12-01'"
CUTOFF_DATE_SQL = "DATE '1999-06-30'"

VENDAS = """
SELECT CAST(l.l_shipdate AS DATE) AS data_venda,
       l.l_suppkey AS loja_id,
       l.l_partkey AS produto_id,
       p.p_type AS categoria,
       CAST(l.l_quantity AS BIGINT) AS quantidade,
       CAST(l.l_extendedprice AS DOUBLE) / NULLIF(CAST(l.l_quantity AS DOUBLE), 0) AS valor_unitario,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS valor_total,
       CAST(FLOOR(l.l_extendedprice * 60 + 0.5) / 100 AS DECIMAL(18,2)) AS custo,
       o.o_custkey AS cliente_id,
       o.o_orderpriority AS canal_venda,
       r.r_name AS regiao,
       l.l_orderkey AS _orderkey
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

VENDAS_SUJA = f"""
SELECT data_venda, loja_id, produto_id,
       CASE WHEN _orderkey % 101 = 3 THEN NULL ELSE categoria END AS categoria,
       CASE WHEN _orderkey % 97 = 5 THEN CAST(-1 AS BIGINT) ELSE quantidade END AS quantidade,
       valor_unitario,
       CASE WHEN _orderkey % 103 = 7 THEN CAST(0 AS DECIMAL(18,2)) ELSE valor_total END AS valor_total,
       custo, cliente_id, canal_venda, regiao
FROM ({VENDAS}) v
"""

CLIENTES_DQ = """
SELECT c.c_custkey AS cliente_id,
       c.c_name AS nome,
       'CPF-' || CAST(CASE WHEN c.c_custkey % 250 = 249 THEN c.c_custkey - 1 ELSE c.c_custkey END AS VARCHAR) AS cpf,
       'user' || CAST(c.c_custkey AS VARCHAR) || CASE WHEN c.c_custkey % 300 = 7 THEN '' ELSE '@' END
         || 'example.com' AS email,
       CASE WHEN c.c_custkey % 50 = 0 THEN 'alt@example.com' END AS email_alt,
       CASE WHEN c.c_custkey % 12 = 0 THEN NULL ELSE 'tel' || CAST(c.c_custkey AS VARCHAR) END AS telefone,
       c.c_mktsegment AS estado,
       CAST(CASE WHEN c.c_acctbal < -900 THEN -1 ELSE 18 + c.c_custkey % 57 END AS BIGINT) AS idade,
       CASE WHEN c.c_custkey % 25 = 3 THEN NULL
            WHEN c.c_custkey % 700 = 11 THEN CAST(100000 AS DOUBLE)
            ELSE c.c_acctbal END AS renda,
       CAST(COALESCE(a.n_pedidos, 0) AS BIGINT) AS compras_12m,
       CASE WHEN c.c_custkey % 400 = 9 THEN CAST(a.primeiro + INTERVAL 100 DAY AS DATE)
            ELSE CAST(a.primeiro - INTERVAL 9000 DAY AS DATE) END AS data_nascimento,
       a.primeiro AS data_cadastro,
       a.ultimo AS data_atualizacao
FROM customer c
LEFT JOIN (SELECT o_custkey, COUNT(*) AS n_pedidos,
                  CAST(MIN(o_orderdate) AS DATE) AS primeiro, CAST(MAX(o_orderdate) AS DATE) AS ultimo
           FROM orders GROUP BY o_custkey) a
  ON c.c_custkey = a.o_custkey
"""


def with_views(body: str) -> str:
    return f"WITH vendas AS ({VENDAS}),\nvendas_suja AS ({VENDAS_SUJA}),\nclientes_dq AS ({CLIENTES_DQ})\n{body}"


def _ate(data: str | None) -> str:
    return f"WHERE data_venda <= {data}" if data else ""


def _ticket_medio(ate: str | None = None, vendas: str = "vendas") -> str:
    return with_views(f"""
, cliente_no_dia AS (
  SELECT data_venda, loja_id, cliente_id, SUM(valor_total) AS gasto, COUNT(*) AS vezes
  FROM {vendas} {_ate(ate)} GROUP BY data_venda, loja_id, cliente_id)
SELECT data_venda, loja_id, CAST(SUM(gasto) AS DOUBLE) AS receita_total, CAST(SUM(vezes) AS BIGINT) AS n_vendas,
       ROUND(CAST(SUM(gasto) AS DOUBLE) / CAST(SUM(vezes) AS DOUBLE), 2) AS ticket_medio,
       COUNT(cliente_id) AS clientes_unicos
FROM cliente_no_dia GROUP BY data_venda, loja_id
""")


def _frequencia(ate: str | None = None) -> str:
    return with_views(f"""
, cliente_na_loja AS (
  SELECT cliente_id, loja_id, date_trunc('month', data_venda) AS inicio, SUM(valor_total) AS gasto, COUNT(*) AS vezes
  FROM vendas {_ate(ate)} GROUP BY cliente_id, loja_id, inicio)
SELECT cliente_id, strftime(inicio, '%Y-%m') AS mes, CAST(SUM(vezes) AS BIGINT) AS compras,
       ROUND(CAST(SUM(gasto) AS DOUBLE), 2) AS gasto_total, COUNT(loja_id) AS lojas_visitadas
FROM cliente_na_loja GROUP BY cliente_id, inicio
""")


def _share(ate: str | None = None, valor: str = "valor_total") -> str:
    return with_views(f"""
, grupos AS (SELECT loja_id, categoria, SUM({valor}) AS entrou, SUM(custo) AS saiu
             FROM vendas {_ate(ate)} GROUP BY loja_id, categoria)
SELECT loja_id, categoria,
       ROUND(CAST(entrou AS DOUBLE) / NULLIF(CAST(SUM(entrou) OVER (PARTITION BY loja_id) AS DOUBLE), 0) * 100, 2)
         AS share_pct,
       ROUND(CAST(entrou AS DOUBLE), 2) AS receita_categoria,
       ROUND(CAST(entrou - saiu AS DOUBLE), 2) AS margem_categoria
FROM grupos
""")


# months of a store with their position, and each month beside the one at the position before
CRESCIMENTO = """
, meses AS (
  SELECT loja_id, date_trunc('month', data_venda) AS inicio, SUM(valor_total) AS valor,
         ROW_NUMBER() OVER (PARTITION BY loja_id ORDER BY date_trunc('month', data_venda)) AS pos
  FROM vendas GROUP BY loja_id, inicio)
, comparados AS (
  SELECT este.loja_id, strftime(este.inicio, '%Y-%m') AS mes, CAST(este.valor AS DOUBLE) AS receita,
         ROUND(CAST(este.valor - outro.valor AS DOUBLE) / NULLIF(CAST(outro.valor AS DOUBLE), 0) * 100, 2)
           AS crescimento_mom_pct
  FROM meses este LEFT JOIN meses outro ON outro.loja_id = este.loja_id AND outro.pos + 1 = este.pos)
"""

_nomes = "[" + ", ".join(f"'{n}'" for n in WEEKDAY_NAMES) + "]"

FEATURES = {
    "ticket_medio": _ticket_medio(),
    "ticket_medio_ate_data": _ticket_medio(CUTOFF_DATE_SQL),
    "frequencia_cliente": _frequencia(),
    "frequencia_cliente_ate_data": _frequencia(CUTOFF_DATE_SQL),
    "share_categoria": _share(),
    "share_categoria_ate_data": _share(CUTOFF_DATE_SQL),
    "share_categoria_fracoes": _share(valor="CAST(valor_total * 0.00375 AS DECIMAL(24,7))"),
    "crescimento_mom": with_views(CRESCIMENTO + "SELECT * FROM comparados"),
    "recencia_cliente": with_views(f"""
SELECT cliente_id, MAX(data_venda) AS ultima_compra, CAST(MIN({REF_DATE_SQL} - data_venda) AS BIGINT) AS dias_desde_ultima
FROM vendas GROUP BY cliente_id
"""),
    "tendencia_7d": with_views("""
, dias AS (SELECT loja_id, data_venda, SUM(valor_total) AS valor,
                  ROW_NUMBER() OVER (PARTITION BY loja_id ORDER BY data_venda) AS pos
           FROM vendas GROUP BY loja_id, data_venda)
, medias AS (
  SELECT d.loja_id, d.data_venda, CAST(d.valor AS DOUBLE) AS receita,
         CAST(SUM(j.valor) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS media
  FROM dias d JOIN dias j ON j.loja_id = d.loja_id AND j.pos BETWEEN d.pos - 6 AND d.pos
  GROUP BY d.loja_id, d.data_venda, d.valor)
SELECT data_venda, loja_id, receita, ROUND(media, 2) AS media_movel_7d,
       ROUND(100 * (receita - media) / NULLIF(media, 0), 2) AS desvio_pct
FROM medias
"""),
    "sazonalidade_dia": with_views(f"""
, dias AS (SELECT loja_id, DAYOFWEEK(data_venda) AS dia_semana, SUM(valor_total) AS valor
           FROM vendas GROUP BY loja_id, dia_semana)
SELECT loja_id, ({_nomes})[dia_semana + 1] AS dia_da_semana, dia_semana,
       ROUND(CAST(valor AS DOUBLE), 2) AS receita_media,
       ROUND(CAST(valor AS DOUBLE) / NULLIF(CAST(SUM(valor) OVER toda AS DOUBLE) / CAST(COUNT(*) OVER toda AS DOUBLE), 0),
             2) AS indice_sazonal
FROM dias WINDOW toda AS (PARTITION BY loja_id)
"""),
    "top_produtos": with_views("""
, itens AS (SELECT loja_id, strftime(data_venda, '%Y-%m') AS mes, produto_id, SUM(valor_total) AS valor
            FROM vendas GROUP BY loja_id, mes, produto_id)
SELECT x.loja_id, x.mes, x.produto_id, CAST(x.valor AS DOUBLE) AS receita, 1 + COUNT(melhor.produto_id) AS "rank"
FROM itens x LEFT JOIN itens melhor
  ON melhor.loja_id = x.loja_id AND melhor.mes = x.mes
 AND (melhor.valor > x.valor OR (melhor.valor = x.valor AND melhor.produto_id < x.produto_id))
GROUP BY x.loja_id, x.mes, x.produto_id, x.valor
HAVING COUNT(melhor.produto_id) < 5
"""),
}


# rows of each feature table and the sum of one of its columns in hundredths
TABLE_SUMS = {"ticket_medio": "receita_total", "frequencia_cliente": "gasto_total", "share_categoria": "share_pct",
              "crescimento_mom": "crescimento_mom_pct", "recencia_cliente": "dias_desde_ultima", "tendencia_7d": "desvio_pct",
              "sazonalidade_dia": "indice_sazonal", "top_produtos": "receita"}
TABLE_SUMMARY = " UNION ALL ".join(
    f"SELECT '{t}' AS tabela, COUNT(*) AS linhas, CAST(SUM(CAST(ROUND({c} * 100.0::DOUBLE) AS BIGINT)) AS BIGINT) AS soma "
    f"FROM ({FEATURES[t]}) AS x" for t, c in TABLE_SUMS.items())
FEATURES |= {"features_oito_tabelas": TABLE_SUMMARY, "inc_resumo_tabelas": TABLE_SUMMARY,
             "inc_tendencia_7d": FEATURES["tendencia_7d"], "inc_frequencia_cliente": FEATURES["frequencia_cliente"]}

_NIVEIS = {"loja_dia": ("CAST(data_venda AS VARCHAR)", "loja_id"), "loja_mes": ("strftime(data_venda, '%Y-%m')", "loja_id"),
           "rede_mes": ("strftime(data_venda, '%Y-%m')", "NULL"), "loja": ("NULL", "loja_id"), "rede": ("NULL", "NULL")}
FEATURES["clientes_niveis"] = with_views(" UNION ALL ".join(
    f"SELECT '{n}' AS nivel, CAST({p} AS VARCHAR) AS periodo, CAST({s} AS BIGINT) AS loja_id, COUNT(DISTINCT cliente_id) AS clientes, "
    f"TRUE AS dentro_do_limite FROM vendas GROUP BY ALL" for n, (p, s) in _NIVEIS.items()))
FEATURES["vendas_copart_canal"] = """
SELECT o_orderpriority AS canal_venda, strftime(l_shipdate, '%Y-%m') AS mes, COUNT(*) AS n_vendas,
       COUNT(DISTINCT o_orderkey) AS n_pedidos,
       CAST(SUM(CAST(ROUND(l_extendedprice * 100.0::DOUBLE) AS BIGINT)) AS BIGINT) AS receita_centavos
FROM lineitem, orders WHERE l_orderkey = o_orderkey GROUP BY ALL
"""

ORACLES: dict[str, str] = {}
ORACLES.update(FEATURES)


# ---------------------------------------------------------------------------------------------------------------
# Validation and cleaning (B-series) on the defect view
# ---------------------------------------------------------------------------------------------------------------
SALES_COLUMNS = ["data_venda", "loja_id", "produto_id", "categoria", "quantidade", "valor_unitario",
                 "valor_total", "custo", "cliente_id", "canal_venda", "regiao"]
FLOAT_SALES_COLUMNS = {"valor_unitario"}


def _missing(c: str, floats) -> str:
    return f"({c} IS NULL OR isnan({c}))" if c in floats else f"{c} IS NULL"


def _null_counts(view: str, cols, floats) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS coluna, COUNT(*) FILTER (WHERE {_missing(c, floats)}) AS nulos FROM {view}" for c in cols)


KEEP_SQL = ("COALESCE(quantidade > 0, FALSE) AND COALESCE(valor_unitario > 0, FALSE) AND NOT COALESCE("
            "isnan(valor_unitario), FALSE) AND COALESCE(valor_total > 0, FALSE)")

_null_cols = ", ".join(f"COUNT(*) FILTER (WHERE {_missing(c, FLOAT_SALES_COLUMNS)}) AS n_{c}" for c in SALES_COLUMNS)
_problem_parts = ", ".join(f"CASE WHEN n_{c} > 0 THEN 'nulos em {c}: ' || CAST(n_{c} AS VARCHAR) END"
                           for c in SALES_COLUMNS)

VALIDATION = {
    "validacao_nulos": with_views(_null_counts("vendas_suja", SALES_COLUMNS, FLOAT_SALES_COLUMNS)),
    "validacao_relatorio": with_views(f"""
, agg AS (SELECT COUNT(*) AS linhas, COUNT(*) FILTER (WHERE NOT ({KEEP_SQL})) AS removidas, {_null_cols}
          FROM vendas_suja)
SELECT ({' AND '.join(f'n_{c} = 0' for c in SALES_COLUMNS)}) AS valido,
       concat_ws(' | ', {_problem_parts}) AS problemas,
       linhas, CAST({len(SALES_COLUMNS)} AS BIGINT) AS colunas, removidas
FROM agg
"""),
    "limpeza_vendas": with_views(f"""
SELECT {', '.join(SALES_COLUMNS)} FROM vendas_suja WHERE {KEEP_SQL}
"""),
}

# ---------------------------------------------------------------------------------------------------------------
# Reports (R-series)
# ---------------------------------------------------------------------------------------------------------------
REPORTS = {
    "perfil_vendas": with_views("""
SELECT MIN(data_venda) AS data_inicio, MAX(data_venda) AS data_fim,
       COUNT(DISTINCT loja_id) AS n_lojas, COUNT(DISTINCT produto_id) AS n_produtos,
       COUNT(DISTINCT cliente_id) AS n_clientes, COUNT(*) AS n_vendas,
       ROUND(CAST(SUM(valor_total) AS DOUBLE), 2) AS receita_total,
       ROUND(CAST(SUM(valor_total) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0), 2) AS ticket_medio
FROM vendas
"""),
    "top_lojas_ticket": with_views("""
SELECT loja_id,
       ROUND(CAST(SUM(valor_total) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0), 2) AS ticket_medio
FROM vendas GROUP BY loja_id
ORDER BY ticket_medio DESC, loja_id LIMIT 5
"""),
    "ultimos_meses_loja": with_views(CRESCIMENTO + """
SELECT * FROM comparados WHERE loja_id = 1 ORDER BY mes DESC LIMIT 3
"""),
}

# ---------------------------------------------------------------------------------------------------------------
# Data-quality audit (D-series) on clientes_dq, reference date 2001-12-01, 730-day limit, key cpf
# ---------------------------------------------------------------------------------------------------------------
DQ_COLUMNS = ["cliente_id", "nome", "cpf", "email", "email_alt", "telefone", "estado", "idade", "renda",
              "compras_12m", "data_nascimento", "data_cadastro", "data_atualizacao"]
DQ_FLOATS = {"renda"}


def _pct_even(num: str, den: str) -> str:
    return f"ROUND_EVEN(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) * 100 * 100, 0) / 100"


_dq_null_cols = ", ".join(f"COUNT(*) FILTER (WHERE {_missing(c, DQ_FLOATS)}) AS n_{c}" for c in DQ_COLUMNS)

DQ_STATS = f"""
, mr AS (SELECT AVG(renda) AS m, STDDEV_SAMP(renda) AS s FROM clientes_dq WHERE renda IS NOT NULL AND NOT isnan(renda))
, mc AS (SELECT AVG(CAST(compras_12m AS DOUBLE)) AS m, STDDEV_SAMP(CAST(compras_12m AS DOUBLE)) AS s
         FROM clientes_dq WHERE compras_12m IS NOT NULL)
, st AS (
  SELECT COUNT(*) AS n,
         COUNT(*) FILTER (WHERE data_atualizacao < {REF_DATE_SQL} - INTERVAL 730 DAY) AS stale,
         CAST(MIN(data_atualizacao) AS DATE) AS oldest,
         {_dq_null_cols},
         COUNT(DISTINCT cpf) AS distinct_cpf, COUNT(*) FILTER (WHERE cpf IS NULL) AS sqlnull_cpf,
         COUNT(*) FILTER (WHERE idade < 0) AS rule_0,
         COUNT(*) FILTER (WHERE email IS NOT NULL AND NOT contains(email, '@')) AS rule_1,
         COUNT(*) FILTER (WHERE data_nascimento > data_cadastro) AS rule_2,
         COUNT(*) FILTER (WHERE renda IS NOT NULL AND NOT isnan(renda)) AS valid_renda,
         COUNT(*) FILTER (WHERE abs((renda - (SELECT m FROM mr)) / NULLIF((SELECT s FROM mr), 0)) > 3) AS out_renda,
         COUNT(compras_12m) AS valid_compras,
         COUNT(*) FILTER (WHERE abs((compras_12m - (SELECT m FROM mc)) / NULLIF((SELECT s FROM mc), 0)) > 3)
           AS out_compras
  FROM clientes_dq)
, k AS (SELECT *, ({' + '.join(f"CASE WHEN {_pct_even('n_' + c, 'n')} > 5 THEN 1 ELSE 0 END" for c in DQ_COLUMNS)})
                  AS k1,
               {_pct_even('stale', 'n')} AS pct2,
               CAST(n - distinct_cpf - CASE WHEN sqlnull_cpf > 0 THEN 1 ELSE 0 END AS BIGINT) AS dups,
               rule_0 + rule_1 + rule_2 AS tot4,
               (CASE WHEN rule_0 > 0 THEN 1 ELSE 0 END + CASE WHEN rule_1 > 0 THEN 1 ELSE 0 END
                + CASE WHEN rule_2 > 0 THEN 1 ELSE 0 END) AS nrules,
               out_renda + out_compras AS tot5,
               (CASE WHEN out_renda > 0 THEN 1 ELSE 0 END + CASE WHEN out_compras > 0 THEN 1 ELSE 0 END) AS ncols
          FROM st)
, dims AS (
  SELECT 1 AS ordem, 'completude' AS dimensao,
         CASE WHEN k1 = 0 THEN 'ok' WHEN k1 <= 2 THEN 'warning' ELSE 'critico' END AS status,
         greatest(0, 20 - 5 * k1) AS score,
         CASE WHEN k1 > 0 THEN CAST(k1 AS VARCHAR) || ' colunas com >5% nulos' ELSE 'Todas as colunas OK' END
           AS detalhes, k1 AS ocorrencias FROM k
  UNION ALL
  SELECT 2, 'frescor',
         CASE WHEN pct2 <= 5 THEN 'ok' WHEN pct2 <= 15 THEN 'warning' ELSE 'critico' END,
         CASE WHEN pct2 <= 5 THEN 20 WHEN pct2 <= 15 THEN 15 ELSE 10 END,
         COALESCE(CAST(pct2 AS VARCHAR), 'nan') || '% dos registros sem atualização há >2 anos', stale FROM k
  UNION ALL
  SELECT 3, 'unicidade',
         CASE WHEN dups = 0 THEN 'ok' WHEN dups <= 2 THEN 'warning' ELSE 'critico' END,
         CASE WHEN dups = 0 THEN 20 WHEN dups <= 2 THEN 15 ELSE 5 END,
         CASE WHEN dups > 0 THEN CAST(dups AS VARCHAR) || ' duplicatas encontradas' ELSE 'Sem duplicatas' END,
         dups FROM k
  UNION ALL
  SELECT 4, 'consistencia',
         CASE WHEN tot4 = 0 THEN 'ok' WHEN tot4 <= 5 THEN 'warning' ELSE 'critico' END,
         CASE WHEN tot4 = 0 THEN 20 WHEN tot4 <= 5 THEN 12 ELSE 5 END,
         CASE WHEN tot4 > 0 THEN CAST(tot4 AS VARCHAR) || ' violações em ' || CAST(nrules AS VARCHAR) || ' regras'
              ELSE 'Todas as regras OK' END, tot4 FROM k
  UNION ALL
  SELECT 5, 'acuracia',
         CASE WHEN tot5 = 0 THEN 'ok' WHEN tot5 <= 5 THEN 'warning' ELSE 'critico' END,
         CASE WHEN tot5 = 0 THEN 20 WHEN tot5 <= 5 THEN 12 ELSE 5 END,
         CASE WHEN tot5 > 0 THEN CAST(tot5 AS VARCHAR) || ' outliers em ' || CAST(ncols AS VARCHAR) || ' colunas'
              ELSE 'Sem outliers' END, tot5 FROM k)
, dimsb AS (SELECT CAST(ordem AS BIGINT) AS ordem, dimensao, status, CAST(score AS BIGINT) AS score, detalhes,
                   CAST(ocorrencias AS BIGINT) AS ocorrencias FROM dims)
, alerts AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY CASE status WHEN 'critico' THEN 0 ELSE 1 END, ordem) AS BIGINT) AS ordem,
         CASE status WHEN 'critico' THEN 'CRITICO' ELSE 'WARNING' END AS nivel, dimensao, detalhes AS mensagem
  FROM dimsb WHERE status IN ('critico', 'warning'))
"""

DQ = {
    "dq_completude": with_views(" UNION ALL ".join(
        f"SELECT '{c}' AS coluna, COUNT(*) FILTER (WHERE {_missing(c, DQ_FLOATS)}) AS nulos, "
        f"{_pct_even(f'COUNT(*) FILTER (WHERE {_missing(c, DQ_FLOATS)})', 'COUNT(*)')} AS pct_nulos, "
        f"COALESCE({_pct_even(f'COUNT(*) FILTER (WHERE {_missing(c, DQ_FLOATS)})', 'COUNT(*)')} > 5, FALSE)"
        f" AS critica FROM clientes_dq" for c in DQ_COLUMNS)),
    "dq_frescor": with_views(DQ_STATS + """
SELECT CAST(stale AS BIGINT) AS registros_desatualizados, pct2 AS pct_desatualizado, oldest AS data_mais_antiga
FROM k
"""),
    "dq_unicidade": with_views(DQ_STATS + "SELECT 'cpf' AS coluna, dups AS duplicatas FROM k"),
    "dq_duplicatas_filtro": with_views(" UNION ALL ".join(
        f"SELECT '{c}' AS coluna, COUNT(*) - COUNT(DISTINCT {c}) - CAST(COUNT(*) > COUNT({c}) AS BIGINT) AS duplicatas "
        "FROM clientes_dq" for c in ("cpf", "telefone", "email_alt"))),
    "dq_chaves_repetidas": """
SELECT concat_ws('-', l_partkey, l_suppkey, CAST(l_shipdate AS DATE)) AS chave, COUNT(*) AS n
FROM lineitem GROUP BY l_partkey, l_suppkey, CAST(l_shipdate AS DATE) HAVING COUNT(*) > 1
""",
    "dq_consistencia": with_views(DQ_STATS + """
SELECT 'idade >= 0' AS regra, CAST(rule_0 AS BIGINT) AS violacoes FROM k
UNION ALL SELECT 'email contém @', CAST(rule_1 AS BIGINT) FROM k
UNION ALL SELECT 'data_nascimento <= data_cadastro', CAST(rule_2 AS BIGINT) FROM k
"""),
    "dq_acuracia": with_views(DQ_STATS + f"""
SELECT 'renda' AS coluna, CAST(valid_renda AS BIGINT) AS validos, CAST(out_renda AS BIGINT) AS outliers,
       {_pct_even('out_renda', 'valid_renda')} AS pct FROM k
UNION ALL
SELECT 'compras_12m', CAST(valid_compras AS BIGINT), CAST(out_compras AS BIGINT),
       {_pct_even('out_compras', 'valid_compras')} FROM k
"""),
    "dq_dimensoes": with_views(DQ_STATS + "SELECT * FROM dimsb"),
    "dq_diagnostico": with_views(DQ_STATS + """
SELECT CAST(SUM(score) AS BIGINT) AS score_qualidade, CAST(100 AS BIGINT) AS score_maximo,
       CASE WHEN COUNT(*) FILTER (WHERE status = 'critico') >= 2 THEN 'ALTA'
            WHEN COUNT(*) FILTER (WHERE status = 'critico') >= 1
              OR COUNT(*) FILTER (WHERE status = 'warning') >= 3 THEN 'MÉDIA'
            WHEN COUNT(*) FILTER (WHERE status = 'warning') >= 1 THEN 'BAIXA' ELSE 'OK' END AS severidade,
       COUNT(*) FILTER (WHERE status = 'ok') AS dimensoes_ok,
       COUNT(*) FILTER (WHERE status = 'warning') AS dimensoes_warning,
       COUNT(*) FILTER (WHERE status = 'critico') AS dimensoes_criticas,
       COUNT(*) FILTER (WHERE status <> 'ok') AS n_alertas
FROM dimsb
"""),
    "dq_alertas": with_views(DQ_STATS + "SELECT * FROM alerts"),
    "perfil_clientes": with_views(DQ_STATS + f"""
SELECT CAST(n AS BIGINT) AS linhas, CAST({' + '.join('n_' + c for c in DQ_COLUMNS)} AS BIGINT) AS celulas_nulas,
       CAST(stale AS BIGINT) AS desatualizados, dups AS duplicatas,
       (SELECT CAST(COUNT(*) FILTER (WHERE contains(email, '@')) AS BIGINT) FROM clientes_dq) AS emails_validos,
       (SELECT MAX(renda) FROM clientes_dq WHERE NOT isnan(renda)) AS renda_max,
       (SELECT ROUND_EVEN(AVG(CAST(compras_12m AS DOUBLE)) * 100, 0) / 100 FROM clientes_dq) AS compras_12m_medio
FROM k
"""),
    "dq_celulas_nulas": with_views(DQ_STATS + f"""
SELECT CAST(n AS BIGINT) AS linhas, CAST({len(DQ_COLUMNS)} AS BIGINT) AS colunas,
       CAST({' + '.join('n_' + c for c in DQ_COLUMNS)} AS BIGINT) AS celulas_nulas,
       CAST({' + '.join('n_' + c for c in DQ_COLUMNS)} AS DOUBLE)
         / NULLIF(CAST(n * {len(DQ_COLUMNS)} AS DOUBLE), 0) * 100 AS pct_celulas_nulas
FROM k
"""),
}

DQ["dq_outliers_uma_leitura"] = DQ["dq_acuracia"]

ORACLES.update(VALIDATION)
ORACLES.update(REPORTS)
ORACLES.update(DQ)


# ---------------------------------------------------------------------------------------------------------------
# Panel (P-series) — store × month, from vendas
# ---------------------------------------------------------------------------------------------------------------
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _share_name(c: str) -> str:
    return "share_" + c.lower()


def _argmax_sql(values, labels) -> str:
    top = f"greatest({', '.join(values)})"
    return "CASE " + " ".join(f"WHEN {v} = {top} THEN {lab}" for v, lab in zip(values, labels)) + " END"


_cat_sums = ",\n         ".join(
    f"COALESCE(SUM(CASE WHEN categoria = '{c}' THEN valor_total END), CAST(0 AS DECIMAL(18,2))) AS cat{i}"
    for i, c in enumerate(CATEGORIES))
_wd_sums = ",\n         ".join(
    f"COALESCE(SUM(CASE WHEN DAYOFWEEK(data_venda) = {k} THEN valor_total END), CAST(0 AS DECIMAL(18,2))) AS wd{k}"
    for k in range(7))
_total_shares = " + ".join(f"cat{i}" for i in range(len(CATEGORIES)))
_shares = ",\n       ".join(
    f"ROUND(CAST(cat{i} AS DOUBLE) / NULLIF(CAST({_total_shares} AS DOUBLE), 0), 4) AS {_share_name(c)}"
    for i, c in enumerate(CATEGORIES))

PANEL_CTE = f"""
, mensal AS (
  SELECT loja_id, strftime(data_venda, '%Y-%m') AS mes,
         SUM(valor_total) AS r, SUM(custo) AS c, COUNT(*) AS n_vendas, COUNT(DISTINCT cliente_id) AS n_clientes,
         {_cat_sums},
         {_wd_sums}
  FROM vendas GROUP BY loja_id, mes)
, regioes AS (SELECT loja_id, MIN(regiao) AS regiao FROM vendas GROUP BY loja_id)
, geral AS (SELECT CAST(SUM(r) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) AS g FROM mensal)
, base AS (
  SELECT m.*,
         CAST(r AS DOUBLE) AS receita,
         ROUND(CAST(r AS DOUBLE) / NULLIF(CAST(n_vendas AS DOUBLE), 0), 2) AS ticket_medio,
         ROUND(CAST(c AS DOUBLE) / NULLIF(CAST(r AS DOUBLE), 0), 4) AS custo_pct,
         CAST(SUM(r) OVER (PARTITION BY loja_id) AS DOUBLE)
           / NULLIF(CAST(COUNT(*) OVER (PARTITION BY loja_id) AS DOUBLE), 0) AS store_mean,
         {', '.join(f'SUM(cat{i}) OVER (PARTITION BY loja_id) AS life{i}' for i in range(len(CATEGORIES)))},
         MAX(n_vendas) OVER (PARTITION BY loja_id) AS area_m2,
         MAX(n_clientes) OVER (PARTITION BY loja_id) AS funcionarios,
         ROW_NUMBER() OVER (PARTITION BY loja_id ORDER BY mes) AS i,
         LAG(r, 3) OVER (PARTITION BY loja_id ORDER BY mes) AS r3,
         LAG(r, 6) OVER (PARTITION BY loja_id ORDER BY mes) AS r6,
         LAG(n_clientes, 1) OVER (PARTITION BY loja_id ORDER BY mes) AS n1,
         LAG(n_clientes, 2) OVER (PARTITION BY loja_id ORDER BY mes) AS n2,
         LEAD(CAST(r AS DOUBLE), 1) OVER (PARTITION BY loja_id ORDER BY mes) AS target
  FROM mensal m)
, base2 AS (
  SELECT *,
         LAG(ticket_medio, 1) OVER (PARTITION BY loja_id ORDER BY mes) AS t1,
         LAG(ticket_medio, 2) OVER (PARTITION BY loja_id ORDER BY mes) AS t2
  FROM base)
, painel AS (
SELECT loja_id, regiao,
       CASE WHEN store_mean / NULLIF((SELECT g FROM geral), 0) < 0.9 THEN 'Pequeno'
            WHEN store_mean / NULLIF((SELECT g FROM geral), 0) > 1.1 THEN 'Grande' ELSE 'Médio' END AS porte,
       {_argmax_sql([f'life{i}' for i in range(len(CATEGORIES))], [f"'{c}'" for c in CATEGORIES])}
         AS categoria_principal,
       CAST(area_m2 AS BIGINT) AS area_m2, CAST(funcionarios AS BIGINT) AS funcionarios,
       mes, CAST(year(CAST(mes || '-01' AS DATE)) AS BIGINT) AS ano,
       receita, ticket_medio, CAST(n_clientes AS BIGINT) AS n_clientes, custo_pct,
       ROUND(receita * (1 - custo_pct), 2) AS margem,
       {_shares},
       COALESCE(ROUND((CAST(r AS DOUBLE) / NULLIF(CAST(r3 AS DOUBLE), 0) - 1) * 100, 2), 0) AS crescimento_3m,
       COALESCE(ROUND((CAST(r AS DOUBLE) / NULLIF(CAST(r6 AS DOUBLE), 0) - 1) * 100, 2), 0) AS crescimento_6m,
       CASE WHEN i >= 3 THEN ROUND(CAST(CAST(t2 AS DECIMAL(18,2)) + CAST(t1 AS DECIMAL(18,2))
                                        + CAST(ticket_medio AS DECIMAL(18,2)) AS DOUBLE) / 3, 2)
            ELSE 0 END AS ticket_3m_avg,
       CAST(CASE WHEN i >= 3 THEN FLOOR((n2 + n1 + n_clientes) / 3) ELSE 0 END AS BIGINT) AS clientes_3m_avg,
       ROUND(CAST(r AS DOUBLE) / NULLIF(store_mean, 0), 4) AS sazonalidade_mes,
       CAST({_argmax_sql([f'wd{k}' for k in range(7)], [str(k) for k in range(7)])} AS BIGINT) AS dia_semana_pico,
       target
FROM base2 LEFT JOIN regioes USING (loja_id))
"""

PANEL = {
    "painel_target": with_views(PANEL_CTE + "SELECT * FROM painel WHERE target IS NOT NULL"),
    "painel_mensal": with_views(PANEL_CTE + """
SELECT loja_id, mes, ano, receita, ticket_medio, n_clientes, custo_pct, margem, target FROM painel
"""),
    "painel_share": with_views(PANEL_CTE + f"""
SELECT loja_id, mes, categoria_principal, {', '.join(_share_name(c) for c in CATEGORIES)} FROM painel
"""),
    "perfil_painel": with_views(PANEL_CTE + """
, p AS (SELECT * FROM painel WHERE target IS NOT NULL)
SELECT CAST(COUNT(DISTINCT loja_id) AS BIGINT) AS n_lojas, CAST(COUNT(*) AS BIGINT) AS n_linhas,
       ROUND(AVG(target), 2) AS target_medio, MIN(target) AS target_min, MAX(target) AS target_max,
       CAST(0 AS BIGINT) AS celulas_nulas
FROM p
"""),
}

# categories outside the given list: derived from the rows, not from columns of the panel above
PANEL["painel_fora_da_lista"] = with_views("""
, g AS (SELECT loja_id, strftime(data_venda, '%Y-%m') AS mes, SUM(valor_total) AS v,
               CASE WHEN categoria IN ('LARGE', 'PROMO', 'SMALL') THEN categoria ELSE 'Outras' END AS grupo
        FROM vendas GROUP BY loja_id, mes, grupo)
, lojas AS (SELECT loja_id, grupo, ROW_NUMBER() OVER (PARTITION BY loja_id
                                                     ORDER BY SUM(v) DESC, grupo = 'Outras', grupo) AS pos
            FROM g GROUP BY loja_id, grupo)
SELECT g.loja_id, g.mes, lojas.grupo AS categoria_principal,
       """ + ", ".join(f"ROUND(CAST(COALESCE(SUM(v) FILTER (WHERE g.grupo = '{c}'), 0) AS DOUBLE)"
                       f" / CAST(SUM(v) AS DOUBLE), 4) AS {_share_name(c)}"
                       for c in ("LARGE", "PROMO", "SMALL", "Outras")) + """
FROM g JOIN lojas ON lojas.loja_id = g.loja_id AND lojas.pos = 1
GROUP BY g.loja_id, g.mes, lojas.grupo
""")

# stores with two regions or none: one row per store and month, region = the store's first one by name
PANEL["painel_regioes"] = with_views("""
, vendas_regioes AS (
  SELECT loja_id, data_venda, valor_total,
         CASE WHEN loja_id % 7 = 3 THEN NULL WHEN loja_id % 5 = 2 AND month(data_venda) % 2 = 0 THEN 'A ' || regiao
              ELSE regiao END AS regiao FROM vendas)
, meses AS (SELECT loja_id, strftime(data_venda, '%Y-%m') AS mes, SUM(valor_total) AS valor FROM vendas_regioes
            GROUP BY loja_id, mes)
, nomes AS (SELECT DISTINCT loja_id, FIRST_VALUE(regiao) OVER (PARTITION BY loja_id ORDER BY regiao NULLS LAST) AS regiao
            FROM vendas_regioes)
SELECT a.loja_id, a.mes, n.regiao, CAST(a.valor AS DOUBLE) AS receita,
       (SELECT CAST(arg_min(b.valor, b.mes) AS DOUBLE) FROM meses b WHERE b.loja_id = a.loja_id AND b.mes > a.mes) AS target
FROM meses a JOIN nomes n ON n.loja_id = a.loja_id
""")

# as many categories as parts: place by name as text, share of the store's month
PANEL["painel_share_pecas"] = with_views("""
, g AS (SELECT loja_id, strftime(data_venda, '%Y-%m') AS mes, CAST(produto_id AS VARCHAR) AS peca, SUM(valor_total) AS v
        FROM vendas GROUP BY ALL)
, lugares AS (SELECT peca, ROW_NUMBER() OVER (ORDER BY peca) - 1 AS posicao FROM (SELECT DISTINCT peca FROM g))
SELECT loja_id, mes, (SELECT COUNT(*) FROM lugares) AS n_categorias, posicao,
       ROUND(CAST(v AS DOUBLE) / CAST(SUM(v) OVER (PARTITION BY loja_id, mes) AS DOUBLE), 4) AS share
FROM g JOIN lugares USING (peca)
""")

ORACLES.update(PANEL)


# ---------------------------------------------------------------------------------------------------------------
# ML (M-series) on the panel rows with a target
# ---------------------------------------------------------------------------------------------------------------
ML_CTE = PANEL_CTE + """
, pt AS (SELECT * FROM painel WHERE target IS NOT NULL)
, sp AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY md5(concat_ws('-', CAST(loja_id AS VARCHAR), mes, '42')), loja_id, mes)
              <= CEIL(COUNT(*) OVER () * 0.2) AS is_test
  FROM pt)
, base_pred AS (
  SELECT 1 AS ordem, 'persistencia' AS modelo, target AS y, receita AS p FROM sp WHERE is_test
  UNION ALL
  SELECT 2, 'media_loja', target, receita / NULLIF(sazonalidade_mes, 0) FROM sp WHERE is_test)
, met AS (
  SELECT CAST(ordem AS BIGINT) AS ordem, modelo,
         ROUND_EVEN((1 - SUM((y - p) * (y - p)) / NULLIF(VAR_POP(y) * COUNT(*), 0)) * 10000, 0) / 10000 AS r2,
         ROUND_EVEN(SQRT(SUM((y - p) * (y - p)) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0)) * 100, 0) / 100 AS rmse,
         ROUND_EVEN(SUM(ABS(y - p)) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) * 100, 0) / 100 AS mae,
         CAST(COUNT(*) AS BIGINT) AS n_amostras
  FROM base_pred GROUP BY ordem, modelo)
"""


def _dummies_sql(col: str) -> str:
    return f"""
SELECT p.loja_id, p.mes, '{col}_' || l.v AS coluna,
       CAST(CASE WHEN p.{col} = l.v THEN 1 ELSE 0 END AS DOUBLE) AS valor
FROM pt p, (SELECT DISTINCT {col} AS v FROM pt
            WHERE {col} IS NOT NULL AND {col} > (SELECT MIN({col}) FROM pt)) l"""


_FEATURES = ["intercepto", "area_m2", "funcionarios", "ticket_medio", "n_clientes", "custo_pct", "margem", "crescimento_3m",
             "crescimento_6m", "ticket_3m_avg", "clientes_3m_avg", "sazonalidade_mes", "dia_semana_pico",
             *[_share_name(c) for c in CATEGORIES]]

ML = {
    "ml_mqr_ortogonal": with_views(ML_CTE + f"""
SELECT unnest({_FEATURES}) AS feature, TRUE AS ortogonal UNION ALL
SELECT DISTINCT coluna, TRUE FROM ({' UNION ALL '.join(_dummies_sql(c) for c in ("regiao", "porte", "categoria_principal"))}) d
"""),
    "ml_modelo_salvo": with_views(ML_CTE + "SELECT loja_id, mes, TRUE AS igual FROM sp WHERE is_test"),
    "ml_modelos_ajuste": with_views(ML_CTE + """
SELECT unnest(['MinimosQuadradosQR', 'RandomForest']) AS modelo, n_amostras, TRUE AS ajuste_ok
FROM (SELECT COUNT(*) AS n_amostras FROM sp WHERE NOT is_test)
"""),
    "ml_dummies": with_views(ML_CTE + " UNION ALL ".join(_dummies_sql(c)
                                                         for c in ("regiao", "porte", "categoria_principal"))),
    "ml_split": with_views(ML_CTE + "SELECT loja_id, mes, is_test FROM sp"),
    "ml_metricas": with_views(ML_CTE + "SELECT * FROM met"),
    "ml_selecao": with_views(ML_CTE + "SELECT * FROM met ORDER BY r2 DESC, ordem LIMIT 1"),
    "ml_resumo": with_views(ML_CTE + f"""
SELECT CAST((SELECT COUNT(DISTINCT loja_id) FROM pt) AS BIGINT) AS n_lojas,
       CAST((SELECT COUNT(DISTINCT mes) FROM pt) AS BIGINT) AS n_meses,
       CAST(12 + {len(CATEGORIES)} + (SELECT COUNT(DISTINCT regiao) - 1 FROM pt)
            + (SELECT COUNT(DISTINCT porte) - 1 FROM pt)
            + (SELECT COUNT(DISTINCT categoria_principal) - 1 FROM pt) AS BIGINT) AS n_features,
       CAST((SELECT COUNT(*) FILTER (WHERE NOT is_test) FROM sp) AS BIGINT) AS n_treino,
       CAST((SELECT COUNT(*) FILTER (WHERE is_test) FROM sp) AS BIGINT) AS n_teste
"""),
}

# one 1 per order in a column named after its key, but for the first key by name
ML["ml_dummies_muitos_niveis"] = """
SELECT o_orderkey, 'pedido_' || CAST(o_orderkey AS VARCHAR) AS coluna, CAST(1 AS DOUBLE) AS valor
FROM orders WHERE CAST(o_orderkey AS VARCHAR) > (SELECT MIN(CAST(o_orderkey AS VARCHAR)) FROM orders)
"""
# a forest predicts means of training targets, so it stays between their least and greatest
ML["ml_floresta_limites"] = with_views(ML_CTE + """
SELECT loja_id, mes, target AS label, TRUE AS dentro FROM sp WHERE is_test
""")

# least squares on one feature has a closed form; the split of the training rows takes another salt
ML["ml_selecao_treinados"] = with_views(ML_CTE + """
, longo AS (UNPIVOT (SELECT is_test, target AS y, CAST(receita AS DOUBLE) AS receita, CAST(n_clientes AS DOUBLE) AS n_clientes,
                            CAST(ticket_medio AS DOUBLE) AS ticket_medio FROM sp)
            ON receita, n_clientes, ticket_medio INTO NAME modelo VALUE x)
, retas AS (SELECT modelo, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM longo WHERE NOT is_test GROUP BY modelo)
, erros AS (SELECT modelo, y, y - (a + b * x) AS e FROM longo JOIN retas USING (modelo) WHERE is_test)
, medidas AS (
  SELECT CAST(list_position(['receita', 'n_clientes', 'ticket_medio'], modelo) AS BIGINT) AS ordem, modelo,
         ROUND_EVEN((1 - SUM(e * e) / (VAR_POP(y) * COUNT(*))) * 10000, 0) / 10000 AS r2,
         ROUND_EVEN(SQRT(AVG(e * e)) * 100, 0) / 100 AS rmse, ROUND_EVEN(AVG(ABS(e)) * 100, 0) / 100 AS mae,
         COUNT(*) AS n_amostras
  FROM erros GROUP BY modelo)
SELECT *, ROW_NUMBER() OVER (ORDER BY r2 DESC, ordem) = 1 AS escolhido FROM medidas
""")
ML["ml_rodadas_validacao"] = with_views(ML_CTE + """
SELECT CAST(n - CEIL(n * 0.2) AS BIGINT) AS n_treino, CAST(CEIL(n * 0.2) AS BIGINT) AS n_validacao, TRUE AS erro_cai,
       TRUE AS erro_confere, TRUE AS aprende
FROM (SELECT COUNT(*) AS n FROM sp WHERE NOT is_test)
""")
ML["ml_largura_loja"] = with_views(ML_CTE + f"""
SELECT CAST(loja_id AS BIGINT) AS loja_id, COUNT(*) AS n_linhas,
       CAST({12 + len(CATEGORIES)} + GREATEST(COUNT(DISTINCT regiao) - 1, 0) + GREATEST(COUNT(DISTINCT porte) - 1, 0)
            + GREATEST(COUNT(DISTINCT categoria_principal) - 1, 0) AS BIGINT) AS n_features
FROM pt WHERE loja_id IN (1, 2) GROUP BY loja_id
""")

ORACLES.update(ML)

ORACLES["top_produtos_resumo"] = ORACLES["top_produtos"]
ORACLES["top_produtos_rede"] = with_views("""
, mensal_rede AS (SELECT strftime(data_venda, '%Y-%m') AS mes, produto_id, SUM(valor_total) AS r FROM vendas GROUP BY ALL)
SELECT mes, produto_id, CAST(r AS DOUBLE) AS receita,
       CAST(ROW_NUMBER() OVER (PARTITION BY mes ORDER BY r DESC, produto_id) AS BIGINT) AS rank
FROM mensal_rede QUALIFY rank <= 5
""")
ORACLES["vendas_por_sql"] = with_views("""
, anos AS (SELECT regiao, EXTRACT(year FROM data_venda) AS ano, cliente_id, COUNT(*) AS n, SUM(valor_total) AS r FROM vendas GROUP BY ALL)
SELECT regiao, ano, CAST(SUM(n) AS BIGINT) AS n_vendas, COUNT(*) AS clientes, CAST(SUM(r) AS DOUBLE) AS receita
FROM anos GROUP BY regiao, ano
""")
ORACLES["features_guardar_primeira"] = f"""
WITH s AS ({ORACLES["share_categoria"]}),
passos AS (SELECT unnest([1, 2, 3]) AS passo, unnest(['overwrite', 'ignore', 'overwrite']) AS modo)
SELECT CAST(passo AS BIGINT) AS passo, modo, COUNT(*) AS linhas, CAST(SUM(CAST(ROUND(share_pct * 100, 0) AS BIGINT)) AS BIGINT) AS soma
FROM passos JOIN s ON passo = 3 OR categoria <> 'PROMO' GROUP BY passo, modo
"""
