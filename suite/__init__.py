"""The registered queries, their oracle SQL, and the inputs both are made from."""
