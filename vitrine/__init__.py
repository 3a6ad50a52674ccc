"""Market-page analytics as Spark DataFrame operators.

Landed web pages go in; keyed product, price and card tables come out.  Every operator takes
and returns DataFrames or Columns, so they compose with ``df.transform`` and stay lazy.
"""
