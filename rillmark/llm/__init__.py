"""Training-data operators: near-duplicates, decontamination, filters, classifiers, mixing, archives.

Nothing outside this folder imports it. Operators that need Python take and give
Arrow batches and work on whole columns; everything between them is DataFrame code.
"""
