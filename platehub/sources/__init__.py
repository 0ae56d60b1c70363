"""platehub.sources"""
