"""coderail: a Spark-native engine for coding (annotating) text tables against a coding scheme.

Layers:
  functions/  Column -> Column expressions (whitespace, names, values, JSON answers)
  sources/    readers and writers (entries, scheme documents, result runs)
  operators/  DataFrame -> DataFrame operators (preparation, joins, prompts, inference,
              validation, results, scheme tables, derived-category rules)
  plans/      fixtures derived from the driver tables and the registered query catalog
  streaming/  incremental coding of arriving texts with Structured Streaming
"""

__version__ = "0.1.0"
