"""Token-transfer analytics as Spark DataFrame jobs.

Stages are functions from DataFrame to DataFrame, lazily composed::

    receipts -> decoded logs -> transfers -> key partials -> daily / overall
                                                          -> summary, series
"""
