"""Training-data operators: language ID, exact and near dedup, decontamination, packing, LM
scoring, URL lists, chat formatting, HTML extraction and WARC archives.

Nothing outside this package imports it. ``queries`` holds the registered queries.
"""
