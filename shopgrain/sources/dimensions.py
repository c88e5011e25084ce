"""Literal dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Category names and their English translation.
CATEGORY_TRANSLATIONS = (
    ("beleza_saude", "Health & Beauty"),
    ("informatica_acessorios", "Computers & Accessories"),
    ("automotivo", "Automotive"),
    ("cama_mesa_banho", "Bed, Bath & Table"),
    ("moveis_decoracao", "Furniture & Decor"),
    ("esporte_lazer", "Sports & Leisure"),
    ("perfumaria", "Perfumery"),
    ("utilidades_domesticas", "Home Utilities"),
    ("telefonia", "Telephony"),
    ("relogios_presentes", "Watches & Gifts"),
    ("alimentos_bebidas", "Food & Beverages"),
    ("bebes", "Baby Products"),
    ("papelaria", "Stationery"),
    ("brinquedos", "Toys"),
    ("pet_shop", "Pet Shop"),
    ("moda_roupas", "Fashion & Clothing"),
    ("calcados", "Shoes"),
    ("eletrodomesticos", "Home Appliances"),
    ("livros", "Books"),
    ("construcao_ferramentas", "Construction & Tools"),
)


def category_translations(spark: SparkSession) -> DataFrame:
    """The translations as a literal relation, whose size Spark knows."""
    values = ", ".join(f"('{name}', '{english}')" for name, english in CATEGORY_TRANSLATIONS)
    return spark.sql(
        f"SELECT * FROM VALUES {values} AS t(product_category_name, product_category_name_english)"
    )
