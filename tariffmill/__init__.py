"""Customs-tariff catalogue building on PySpark: parse, check, merge, report and export."""
