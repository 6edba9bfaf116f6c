"""Training-data operators: scoring, packing, privacy, toxicity, URL rules, token counts, quality, joins.

Nothing outside this subpackage imports it. Every operator takes DataFrames and
returns a DataFrame; ``queries`` applies each one to its whole intended table.
"""
