"""platehub.streaming"""
