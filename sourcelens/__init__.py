"""sourcelens: Spark-native source-portrayal analytics.

Every operator is a DataFrame job (DataFrame in, DataFrame out) or a function
returning a native ``Column`` expression; nothing iterates rows on the driver.
"""

from sourcelens.rules import BrandRules

__all__ = ["BrandRules"]
