"""The whole job, the query registry and its SQL counterparts."""
