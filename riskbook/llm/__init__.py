"""Training-data operators: language ID, near-duplicate and repeated-passage
removal, toxicity, personal data, source mixing, packing, token files, sketches
and nearest-neighbour search. Nothing else in the library imports this package."""
