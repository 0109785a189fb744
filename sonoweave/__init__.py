"""sonoweave: Spark-native analytics over time-aligned speech and text.

Everything is a function from DataFrames to a DataFrame.  The subpackages are

* ``functions``  column expressions (text, z-scores, frame arrays) and signal kernels,
* ``sources``    readers and writers (wav/txt trees, configuration, statistics),
* ``operators``  relational operators (segmentation, controls, calibration, intervals),
* ``plans``      whole queries over the standard tables and their SQL counterparts,
* ``streaming``  incremental calibration,
* ``llm``        text operators for training corpora; nothing else imports it.
"""
