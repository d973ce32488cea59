"""Training-data operators over documents, pages and conversations.

Nothing outside this subpackage imports it; ``__spark_entry__`` registers its
queries only when it can be imported.
"""
