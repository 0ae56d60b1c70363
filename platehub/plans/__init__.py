"""platehub.plans"""
