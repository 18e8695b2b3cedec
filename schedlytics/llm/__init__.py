"""Operators of a training-data pipeline: archives, scoring, mixing, formatting, tokens, languages, rules, licences, search, joins."""

import sys

from pyspark import cloudpickle

# Executors get the functions of this subpackage with the job, so they need no copy of the repository on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
