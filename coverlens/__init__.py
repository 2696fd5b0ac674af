"""Coverage analytics on Spark: where a subject is mentioned in news and web documents.

Every job is a DataFrame plan.  Story feeds land incrementally, raw pages become
article records, the best sentence that mentions a keyword is kept, stories are
conformed to a star schema, audited, exported, and queried as linked facets.
"""
