"""agroclim: regional climate and agriculture analytics as PySpark DataFrame functions.

Modules:
    functions   Column expressions (labels, parsing, rounding, classes, colours, formats)
    operators   DataFrame -> DataFrame operators (silver, gold, cleaning, report, quality, planning)
    sources     bronze readers, CSV sniffing, sinks, the proxy panel over the driver tables
    plans       batch jobs, serving and publish, upserts, the registered query catalog
    streaming   incremental bronze -> silver with Structured Streaming
"""

__version__ = "0.1.0"
