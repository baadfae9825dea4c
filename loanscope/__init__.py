"""loanscope: Spark-native analytics over mortgage-application disclosure records.

Layers (each one a plain DataFrame API module):

* ``sources``   - readers for the yearly pipe-delimited registers, reference files,
                  the test fixture views, and the sinks;
* ``functions`` - scalar ``Column`` builders (lenient casts, buckets, labels);
* ``operators`` - cube builders, reports, slice filters, rollups, rankings, lookups;
* ``plans``     - user-facing views, the materialising warehouse and batch jobs;
* ``streaming`` - incremental ingest of newly landed register files.
"""

__version__ = "0.1.0"
