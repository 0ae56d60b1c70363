"""platehub.testing"""
