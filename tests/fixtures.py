"""Small hand-made frames; the expected results in the tests are computed by hand from these rows."""

import datetime as dt

SALES_SCHEMA = ("data_venda timestamp, loja_id bigint, produto_id bigint, categoria string, quantidade bigint, "
                "valor_unitario double, valor_total double, custo double, cliente_id bigint, canal_venda string, "
                "regiao string")


def _d(text):
    return dt.datetime.fromisoformat(text)


def vendas_teste(spark):
    """Two stores over two months: several sales in a day, a returning customer and a tie between products."""
    return spark.createDataFrame([
        (_d("2024-03-04"), 11, 501, "Padaria", 4, 2.5, 10.0, 6.0, 71, "balcao", "Norte"),
        (_d("2024-03-04"), 11, 502, "Bebidas", 2, 15.0, 30.0, 18.0, 72, "balcao", "Norte"),
        (_d("2024-03-05"), 11, 501, "Padaria", 8, 2.5, 20.0, 12.0, 71, "web", "Norte"),
        (_d("2024-04-02"), 11, 503, "Limpeza", 3, 30.0, 90.0, 45.0, 73, "web", "Norte"),
        (_d("2024-04-02"), 11, 502, "Bebidas", 4, 15.0, 60.0, 36.0, 71, "balcao", "Norte"),
        (_d("2024-03-10"), 12, 503, "Limpeza", 1, 40.0, 40.0, 20.0, 71, "balcao", "Oeste"),
        (_d("2024-04-13"), 12, 503, "Limpeza", 2, 5.0, 10.0, 5.0, 74, "balcao", "Oeste"),
        (_d("2024-04-13"), 12, 501, "Padaria", 1, 10.0, 10.0, 4.0, 74, "balcao", "Oeste"),
    ], SALES_SCHEMA)


def vendas_invalidas(spark):
    """Nulls in three columns; two of the four rows are no sales (no quantity, a negative total)."""
    return spark.createDataFrame([
        (_d("2024-03-04"), 11, 501, "Padaria", 4, 2.5, 10.0, 6.0, 71, "balcao", "Norte"),
        (_d("2024-03-05"), 12, 502, "Bebidas", 1, 15.0, 15.0, 9.0, None, "web", "Oeste"),
        (_d("2024-03-06"), None, 503, "Limpeza", 0, 30.0, 30.0, 15.0, 72, "web", None),
        (_d("2024-03-07"), 11, 501, "Padaria", 2, 2.5, -3.0, 6.0, 73, "balcao", None),
    ], SALES_SCHEMA)


DQ_SCHEMA = ("cpf string, email string, email_alt string, telefone string, idade bigint, renda double, "
             "compras_12m bigint, data_nascimento timestamp, data_cadastro timestamp, data_atualizacao timestamp")


def clientes_limpo(spark):
    """One missing cell in four rows."""
    return spark.createDataFrame([
        ("901", "ana@loja.test", "a2@loja.test", "3000", 41, 3200.0, 4, _d("1984-02-10"), _d("2018-09-01"), _d("2025-01-20")),
        ("902", "bia@loja.test", None, "3001", 52, 4100.0, 7, _d("1973-07-04"), _d("2017-05-12"), _d("2025-03-02")),
        ("903", "caio@loja.test", "c2@loja.test", "3002", 33, 2800.0, 2, _d("1992-11-23"), _d("2022-02-28"), _d("2024-12-15")),
        ("904", "davi@loja.test", "d2@loja.test", "3003", 27, 3600.0, 9, _d("1998-04-18"), _d("2023-08-08"), _d("2025-10-30")),
    ], DQ_SCHEMA)


def clientes_sujo(spark):
    """One key three times, one stale row, a negative age, two e-mails without @, a birth after the registration."""
    return spark.createDataFrame([
        ("901", "ana@loja.test", None, None, 41, 3200.0, 4, _d("1984-02-10"), _d("2018-09-01"), _d("2021-04-05")),
        ("901", "bia.loja.test", None, "3001", -2, None, 7, _d("1973-07-04"), _d("2017-05-12"), _d("2025-03-02")),
        ("901", "caio@loja.test", "c2@loja.test", "3002", 33, 2800.0, 2, _d("2023-01-01"), _d("2022-02-28"), _d("2024-12-15")),
        ("905", "davi-loja", None, "3003", 27, 3600.0, 9, _d("1998-04-18"), _d("2023-08-08"), _d("2025-10-30")),
        ("906", "eva@loja.test", "e2@loja.test", "3004", 38, 2900.0, 3, _d("1987-06-30"), _d("2019-01-15"), _d("2025-07-07")),
    ], DQ_SCHEMA)
